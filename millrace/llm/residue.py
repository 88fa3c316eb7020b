"""Problem 3: template residue, filler, error pages and demands for scripts.

Labelled exemplars of residue are kept in an inverted index from term to
exemplar. A text is cut into passage windows (headings, lines, sentences). A
window looks its terms up in the index and is scored against each exemplar they
name by TF-IDF containment: how much of the window's weight the exemplar
covers, and how much of the exemplar's weight the window holds. Windows that an
exemplar covers almost whole are residue; a sentence that merely mentions an
error page keeps most of its weight outside and is not. Quoted and code-marked
passages are talked about, never meant, and are removed first.

Document frequencies come from one pass over the whole collection, those of
terms outside the index too. Terms that a hundredth of the texts hold are known
to every task; of the rarer ones a window's own are looked up only where their
weight decides.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.runtime import materialize, spread

# Labelled residue. Numbers stand for any number, <placeholder>,
# {{placeholder}} and the like for any of their kind.
PLACEHOLDERS = """
Hi %NAME%,
Dear %NAME%,
Regards, %NAME%
%NAME%
Jira: __TICKET_ID__
Ticket: __TICKET_ID__
Owner: __YOUR_NAME__
__change__ (#{{number}})
{{ summary }}
{{ title }}: {{ summary }}
{{ type }}({{ scope }}): {{ summary }}
Release note: {% block note %}{% endblock %}
Impact: <%= impact %>
Tested on: ${OS_NAME}
Steps: <first step>
Expected: <what should happen>
Actual: <what happens instead>
Fixes #<ticket>
Closes #XXXX
Closes #ISSUE_NUMBER
See also #ISSUE_NUMBER
Add <feature> to <module>
Fix <component>: <what>
<type>: <summary in one line>
<type>(<scope>): <subject>
fix: ${change}
fix: %title%
[TITLE]
[TICKET-000] replace me
[INSERT DESCRIPTION HERE]
[YOUR TEXT]
[SCREENSHOT]
[ADD LINK TO DESIGN]
[Replace this paragraph]
Related: [LINK]
TODO: write a description
TODO: add description
(no description yet, fill in before review)
<!-- Describe your change here -->
<!-- Explain the reason -->
<!-- What does this do? Why is it needed? -->
<!-- one paragraph, please -->
<!-- motivation goes here -->
<!-- link the discussion -->
<text>
${TEXT}
__TEXT__
Your title here
Enter title here
Title goes here
Description goes here
Titel hier eintragen
Beschreibung hier eintragen
Titre à compléter
Ajouter un titre ici
Escribe aquí el título
Describe your changes here
Please describe your changes
Insert description here
""".strip().split("\n")
FILLER = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat duis aute irure
blah blah
asdf asdf
qwer qwer
qwerty qwerty
foo bar baz
test test test 123
tbd tbd
xxx xxx
aaaa bbbb
dummy title
dummy text
some text here
Sample text goes here.
Replace before publishing.
This is placeholder copy, the real text follows later.
This is placeholder text.
placeholder text
Hier steht ein Platzhaltertext für
Blindtext
Texte provisoire à remplacer avant la publication.
Texto de ejemplo.
Sustituir antes de publicar.
Beispieltext
Vor der Veröffentlichung ersetzen.
""".strip().split("\n")
FAILURES = """
404 Not Found
403 Forbidden
401 Unauthorized
408 Request Timeout
429 Too Many Requests
500 Internal Server Error
502 Bad Gateway
503 Service Unavailable
503 Unavailable
504 Gateway Timeout
500 Oops
Oops
Error 404
404 Error
HTTP 500
HTTP Error 500
Page not found
The page you asked for could not be found.
The page you requested could not be found.
Go back to the start page.
Return to the home page.
This content is no longer available or was moved.
This page is no longer available.
The site is down for maintenance.
Wegen Wartungsarbeiten nicht erreichbar
Sorry, something went wrong on our side.
Something went wrong.
Please try again in a few minutes.
Please try again later.
The gateway lost its upstream while reading headers (cause: timeout)
You have sent too many requests.
Wait 30 seconds and reload.
Access denied.
You do not have permission to view this resource.
You do not have permission to access this page.
Your session has expired.
Sign in again to continue.
You must be logged in to see this discussion.
Sign in or create an account.
Log in to continue
Sign in to continue
Please sign in
Menu Sign in Search
Die angeforderte Seite wurde nicht gefunden.
Seite nicht gefunden
Zugriff verweigert
Bitte melden Sie sich an, um fortzufahren.
Ihre Sitzung ist abgelaufen.
Etwas ist schiefgelaufen.
La page demandée est introuvable.
Page introuvable
Accès refusé
Veuillez vous connecter pour continuer.
Votre session a expiré.
No se ha encontrado la página solicitada.
Página no encontrada
Acceso denegado
Inicie sesión para continuar.
Su sesión ha caducado.
""".strip().split("\n")
SCRIPTS = """
Please enable JavaScript to view this page.
Enable JavaScript to continue
You need to enable JavaScript to run this app.
JavaScript is disabled
JavaScript is required
This application requires JavaScript.
Activate it and reload.
Scripts and cookies must be allowed.
Scripts are disabled; the application cannot start.
Please enable cookies
Checking your browser before opening
Just a moment while we check your browser
Just a moment
This takes a moment.
Bitte aktivieren Sie JavaScript, um fortzufahren.
JavaScript ist deaktiviert
Veuillez activer JavaScript pour continuer.
JavaScript est désactivé
Active JavaScript en su navegador para continuar.
JavaScript está desactivado
""".strip().split("\n")
# Filler that is named after what it fills.
FILLER += [f"{a} {b}" for a in ("dummy", "sample", "placeholder") for b in ("title", "text", "description")]
EXEMPLARS = [*PLACEHOLDERS, *FILLER, *FAILURES, *SCRIPTS]


def exemplar_table(spark: SparkSession) -> DataFrame:
    """The labelled exemplars above as ``text, label``, the form in which own ones are given."""
    kinds = {"placeholder": PLACEHOLDERS, "filler": FILLER, "failure": FAILURES, "scripts": SCRIPTS}
    return spark.createDataFrame([(x, k) for k, xs in kinds.items() for x in xs], "text string, label string")


COVER = 0.7  # of the window's weight inside the exemplar
HELD = 0.6  # of the exemplar's weight inside the window
ENOUGH = 15.0  # covered weight that counts whatever share of the exemplar it is
WHOLE, SOME = 0.95, 8.0  # or so much of a short window, if it weighs that much
COMMON = 0.01  # share of texts from which on a term's frequency is known to every task: 100 times the terms of a text at most
RARE = 1 / 12_000  # added to the share of rows that hold a term; bounds weights alike for any number of rows

# ------------------------------------------------------------- terms, windows
_SHAPES = [
    (re.compile(r"\{%.*?%\}"), " ‹slot› "),
    (re.compile(r"\{\{.*?\}\}"), " ‹slot› "),
    (re.compile(r"<%.*?%>"), " ‹slot› "),
    (re.compile(r"\$\{\s*\w[^}\n]*\}"), " ‹slot› "),
    (re.compile(r"(@@|##|\$\$|~~)\w+\1"), " ‹slot› "),
    (re.compile(r"%(?:[A-Z][A-Z_ ]+|[a-z_]{2,})%"), " ‹slot› "),
    (re.compile(r"\b__[A-Za-z]\w*?__\b"), " ‹slot› "),
    (re.compile(r"\[[A-Z]+-0+\]"), " ‹bracket› "),
    (re.compile(r"\[[A-Z][A-Z_ ]{2,}\](?!\()"), lambda m: " ‹bracket› " + m.group()[1:-1]),
    (re.compile(r"#[A-Z][A-Z_]{2,}\b"), " ‹slot› "),
    (re.compile(r"</?(?:html|head|title|body|center|h[1-6]|hr|p|div|span|br|noscript|!doctype)\b[^>]*>", re.I), "\n"),
    (re.compile(r"<[a-z][a-z]+(?:[ _-][a-z]+)*>"), " ‹slot› "),
]
_QUOTED = re.compile(r"```.*?```|`[^`\n]*`|\"[^\"\n]*\"|“[^”\n]*”|«[^»\n]*»|„[^“\n]*“", re.S)
_COMMENT = re.compile(r"<!--(.*?)-->", re.S)
_BREAK = re.compile(r"\n+|(?<=[.!?])\s+(?=\S)|\s[|·–—-]\s|\s*</?(?:html|head|title|body|center|h[1-6]|hr|p|div|br|noscript|!doctype)\b[^>]*>\s*", re.I)
_BULLET = re.compile(r"^\s*(?:[#>*+-]+\s*)?(?:\[[ xX]\]\s*)?")
# What a title or form line is about stands before it: [scope], scope:, scope(part):
_SCOPE = re.compile(r"^\s*(?:\[[^\[\]\n]*\]|[\w-]+(?:\([^()\n]*\))?!?:)\s+(?=\S)")
_TERM = re.compile(r"‹\w+›|[^\W\d_]+|\d+")
_RUN = re.compile(r"^(.)\1{2,}$")


def terms(window: str) -> list[str]:
    """Lower-case words; numbers, runs of one letter and placeholders by their kind."""
    for shape, kind in _SHAPES:
        window = shape.sub(kind, window)
    out = []
    for t in _TERM.findall(window):
        out.append("‹n›" if t[0].isdigit() else "‹run›" if _RUN.match(t) else t if t[0] == "‹" else t.lower())
    return out


def windows(text: str) -> Iterator[list[str]]:
    """The passage windows of a text as terms; comments of a form are windows of their own."""
    text = _QUOTED.sub(" ‹quote› ", text)
    for c in _COMMENT.findall(text):
        yield ["‹comment›", *terms(c)]
    for part in _BREAK.split(_COMMENT.sub(" ", text)):
        part = _BULLET.sub("", part, count=1)
        got = terms(part)
        if got:
            yield got
            scope = _SCOPE.match(part)
            if scope and (rest := terms(part[scope.end() :])):
                yield rest


def _exemplar_terms(line: str) -> list[list[str]]:
    """An exemplar as it is, and one that holds a placeholder also without its scope."""
    c = _COMMENT.fullmatch(line)
    if c:
        return [["‹comment›", *terms(c.group(1))]]
    scope = _SCOPE.match(line)
    bare = terms(line[scope.end() :]) if scope else []
    return [terms(line), *([bare] if any(t[0] == "‹" for t in bare) else [])]


def weight(df: int, n: int) -> float:
    """The weight of a term that ``df`` of ``n`` texts hold."""
    return 0.1 - math.log(min(1.0, df / n + RARE))


class Index:
    """Inverted index over the exemplars, weighted by the collection's document frequencies.

    ``df`` holds the frequencies of the exemplars' terms and of all common ones.
    """

    def __init__(self, exemplars: Sequence[str], df: dict[str, int] | None = None, n: int = 0) -> None:
        pairs = [(i, frozenset(t)) for i, x in enumerate(exemplars) for t in _exemplar_terms(x)]
        self.source = [i for i, _ in pairs]
        self.sets = [t for _, t in pairs]
        self.vocabulary = frozenset().union(*self.sets) if pairs else frozenset()
        df = df or {}
        self.idf = {t: weight(df.get(t, 0), n) for t in {*self.vocabulary, *df}} if n else {}
        self.rarest, self.least = weight(0, max(n, 1)), 0.1 - math.log(COMMON + RARE)
        self.weight = [sum(self.idf.get(t, 1.0) for t in s) for s in self.sets]
        self.postings: dict[str, list[int]] = defaultdict(list)
        for i, s in enumerate(self.sets):
            for t in s:
                self.postings[t].append(i)

    def look(self, window: Sequence[str]) -> tuple[int, float, float, list[str]] | None:
        """``exemplar, its mass, mass of the window but for its rare terms, rare terms`` if an exemplar may cover the window."""
        own = set(window)
        known = own & self.vocabulary
        if not known:
            return None
        others = own - known
        rare = [t for t in others if t not in self.idf]
        inside = sum(self.idf[t] for t in known)
        whole = inside + sum(self.idf[t] for t in others if t in self.idf)
        if inside < COVER * (whole + self.least * len(rare)):
            return None
        mass: Counter[int] = Counter()
        for t in known:
            w = self.idf[t]
            for i in self.postings[t]:
                mass[i] += w
        for i, m in mass.most_common():
            if m < COVER * (whole + self.least * len(rare)):
                return None
            # one ordinary word is no passage unless it is the whole exemplar
            if len(own) == 1:
                fits = m >= 0.9 * self.weight[i]
            else:
                fits = m >= HELD * self.weight[i] or m >= ENOUGH or (m >= SOME and not rare and m >= WHOLE * whole)
            if fits:
                return self.source[i], m, whole, rare
        return None

    def hit(self, window: Sequence[str]) -> int | None:
        """The exemplar that covers the window, if any; terms of unknown frequency count as the rarest."""
        got = self.look(window)
        return got[0] if got and got[1] >= COVER * (got[2] + self.rarest * len(got[3])) else None


# -------------------------------------------------------------------- operator
FLUSH = 200_000  # terms counted in a task before they are handed on


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df: Counter[str] = Counter()
    n = 0

    def out() -> pa.RecordBatch:
        rows = [*df.items(), ("", n)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["term", "n"])

    for b in batches:
        for texts in zip(*(b.column(i).to_pylist() for i in range(1, b.num_columns))):
            n += 1
            df.update({t for x in texts if x for w in windows(x) for t in w})
        if len(df) > FLUSH:
            yield out()
            df, n = Counter(), 0
    yield out()


LOOKED = "row_key bigint, field string, exemplar int, mass double, whole double, rare array<string>"


def _judge(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            names = b.schema.names
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for at in range(1, b.num_columns):
                for key, text in zip(columns[0], columns[at]):
                    open_: list[tuple] = []
                    for w in windows(text) if text else ():
                        got = index.look(w)
                        if not got:
                            continue
                        i, mass, whole, rare = got
                        if mass >= COVER * (whole + index.rarest * len(rare)):
                            open_ = [(key, names[at], i, mass, whole, [])]
                            break
                        open_.append((key, names[at], i, mass, whole, rare))
                    rows += open_
            types = (pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], [x.split()[0] for x in LOOKED.split(", ")]
            )

    return run


def residue(
    rows: DataFrame,
    fields: Sequence[str] = ("title", "body"),
    row_key: str = "row_id",
    exemplars: DataFrame | Sequence[str] = tuple(EXEMPLARS),
) -> DataFrame:
    """``row_key, field, exemplar`` for every field that holds residue.

    NULL and empty texts hold none. ``exemplars`` are texts, or a table with a
    column ``text`` (labelled rows, small enough for every task). Only the
    frequencies of their terms and of common ones reach the driver, of which a
    text holds no more on average than it has terms.
    """
    if isinstance(exemplars, DataFrame):
        exemplars = [r[0] for r in exemplars.where("text is not null").select("text").distinct().orderBy("text").collect()]
    bare = Index(exemplars)
    narrow = spread(rows.select(F.col(row_key).cast("bigint").alias("row_key"), *[F.col(f).cast("string") for f in fields]))
    counted = materialize(narrow.mapInArrow(_frequencies, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")), "terms")
    total = counted.where("term = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] or 1
    shared = counted.where((F.col("n") >= F.lit(COMMON * total)) | F.col("term").isin(sorted(bare.vocabulary)))
    index = Index(exemplars, {r["term"]: r["n"] for r in shared.where("term != ''").collect()}, total)
    looked = materialize(narrow.mapInArrow(_judge(index), LOOKED), "looked")
    sure = looked.where("size(rare) = 0").select("row_key", "field", "exemplar")
    # no term here is common, so none is a hot key
    window = looked.where("size(rare) > 0").withColumn("window", F.monotonically_increasing_id())
    weighed = (
        materialize(window, "looked")
        .select("*", F.explode("rare").alias("term"))
        .join(counted.hint("merge"), "term", "left")  # the table of terms grows with the data
        .groupBy("window")
        .agg(
            *[F.first(c).alias(c) for c in ("row_key", "field", "exemplar", "mass", "whole")],
            F.sum(F.lit(0.1) - F.log(F.least(F.lit(1.0), F.coalesce("n", F.lit(0)) / F.lit(total) + F.lit(RARE)))).alias("others"),
        )
        .where(F.col("mass") >= F.lit(COVER) * (F.col("whole") + F.col("others")))
    )
    return sure.unionByName(weighed.select("row_key", "field", "exemplar")).groupBy("row_key", "field").agg(F.min("exemplar").alias("exemplar"))


def without_residue(rows: DataFrame, row_key: str = "row_id", **kw) -> DataFrame:
    """``rows`` without those that hold residue in any of the fields; rows of a NULL key stay."""
    gone = residue(rows, row_key=row_key, **kw).select(F.col("row_key").alias(row_key)).distinct()
    return rows.join(gone, row_key, "left_anti")
