"""Predicates and parts of file paths, as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words and suffixes by which documentation, tests and build files are known.
DOC_EXTENSIONS = "md txt yml yaml json toml ini cfg rst adoc csv svg png jpg jpeg gif ico".split()
DOC_NAMES = (
    "readme changelog license licence contributing authors codeowners code_of_conduct"
    " .gitignore .editorconfig .prettierrc .eslintignore"
).split()
TEST_NAMES = (
    r"^(?:test[_.].*|.*_test\.(?:py|go|rs|js|ts)|.*\.test\.(?:js|ts|tsx|jsx)|.*\.spec\.(?:js|ts|rs)"
    r"|.*_spec\.rb|.*test\.java|conftest\.py|pytest\.ini|jest\.config\.(?:js|ts))$"
)
TEST_FOLDERS = r"/(?:tests|test|__tests__|spec)/"
TEST_IN_PATCH = r"/test|_test\.(?:py|rs|js|ts)$|\.spec\.(?:rs|ts|js)$|/spec/"
MANIFESTS = (
    "requirements.txt setup.py setup.cfg pyproject.toml package.json package-lock.json yarn.lock pnpm-lock.yaml go.mod"
    " go.sum cargo.toml cargo.lock pom.xml build.gradle build.gradle.kts gemfile gemfile.lock makefile cmake cmakelists.txt"
).split()
SOURCE_SUFFIXES = r"\.(?:py|rs|go|java|js|ts|rb|kt)$"


def basename(path: Column) -> Column:
    """The part behind the last slash."""
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """The part of the base name behind the last dot; the whole name if it has none."""
    return F.substring_index(basename(path), ".", -1)


def is_test(path: Column) -> Column:
    """Test files by name or folder. Folders count only behind a slash."""
    low = F.lower(path)
    return basename(low).rlike(TEST_NAMES) | low.rlike(TEST_FOLDERS)


def is_test_in_patch(path: Column) -> Column:
    """The wider rule by which diffs are split into solution and tests."""
    return F.lower(path).rlike(TEST_IN_PATCH)


def is_doc(path: Column) -> Column:
    low = F.lower(path)
    starts = F.lit(False)
    for n in DOC_NAMES:
        starts = starts | basename(low).startswith(n)
    return extension(low).isin(DOC_EXTENSIONS) | starts


def has_build(paths: Column) -> Column:
    """Whether any path is a manifest or source file."""
    return F.exists(paths, lambda p: basename(F.lower(p)).isin(MANIFESTS) | F.lower(p).rlike(SOURCE_SUFFIXES))


def all_of(paths: Column, rule) -> Column:
    """Whether the list is not empty and every path obeys ``rule``."""
    return (F.size(paths) > 0) & F.forall(paths, rule)


# Validators of identifiers. Lengths are bytes.
def valid_ref(c: Column) -> Column:
    return (F.octet_length(c) <= 256) & c.rlike(r"^[A-Za-z0-9/._~^][A-Za-z0-9/._~^-]*\z") & ~c.contains("..")


def valid_repo(c: Column) -> Column:
    part = r"[A-Za-z0-9_][A-Za-z0-9._-]*"
    return (F.octet_length(c) <= 256) & c.rlike(rf"^{part}/{part}\z")


def valid_path(c: Column) -> Column:
    return (
        c.rlike(r"\A[^\x00;|&$`(){}<>!'\"\n\r\\]+\z")
        & (F.octet_length(c) <= 4096)
        & ~c.contains("..")
        & ~c.startswith("/")
    )
