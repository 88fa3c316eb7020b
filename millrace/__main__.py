from millrace.cli import run

run()
