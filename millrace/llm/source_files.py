"""Problem 4: generated, minified and vendored files, lock files and data saved as code.

A character trigram model of identifiers is trained per language on the files
that nothing else makes suspect. Under these models every changed file is
measured in three ways:

* Cross-entropy. The dearest run of consecutive names, in bits per character.
  Mangled names, encoded blobs, digests, and the wording of tools in an otherwise
  ordinary file stand far above what people write in that language.
* Diversity. The share of distinct names in a moving window, digits folded.
  Templates, lock files and number tables repeat a few forms.
* Style. How much better the names fit the model of another language than that
  of the file's own suffix. Copied and emitted files often do.

The bounds of the measures are quantiles of the unsuspected files of each
language, from the whole collection. What names cannot show (a notice in the
file's first comments, a place where tools and package managers keep files, a
file without a diff) is completed by notices and places; see README for how
many files need them.

Diffs are judged where they are stored: only verdicts are shuffled, never text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import fold, materialize, spread

# ------------------------------------------------------------------ languages
# File suffixes by language.
LANGUAGES = {
    "python": ("py", "pyi"),
    "javascript": ("js", "jsx", "mjs", "cjs"),
    "typescript": ("ts", "tsx"),
    "go": ("go",),
    "rust": ("rs",),
    "java": ("java",),
    "kotlin": ("kt", "kts"),
    "ruby": ("rb",),
    "c": ("c", "h", "cc", "cpp", "hpp"),
    "csharp": ("cs",),
    "dart": ("dart",),
    "swift": ("swift",),
    "php": ("php",),
    "scala": ("scala",),
    "shell": ("sh", "bash"),
    "sql": ("sql",),
    "proto": ("proto",),
    "json": ("json",),
    "yaml": ("yaml", "yml"),
    "toml": ("toml", "cfg", "ini"),
    "markup": ("html", "htm", "xml", "svg", "vue"),
    "style": ("css", "scss", "less"),
}
_BY_SUFFIX = {s: lang for lang, all_ in LANGUAGES.items() for s in all_}
CODES = sorted(LANGUAGES)
PROSE = frozenset("md rst txt adoc markdown".split())


def language_of(path: str) -> str | None:
    return _BY_SUFFIX.get(path.rpartition(".")[2].lower())


# --------------------------------------------------------------------- places
# Names that package managers and tools give to files and folders.
LOCK_FILES = r"(?:^|/)(?:package-lock\.json|npm-shrinkwrap\.json|pnpm-lock\.yaml|yarn\.lock|cargo\.lock|poetry\.lock|pipfile\.lock|gemfile\.lock|composer\.lock|mix\.lock|flake\.lock|podfile\.lock|pubspec\.lock|uv\.lock|pdm\.lock|bun\.lockb?|go\.sum|gradle\.lockfile|packages\.lock\.json)$"
VENDORED = r"(?:^|/)(?:vendor|third[_-]?party|node_modules|bower_components|godeps|_workspace|site-packages|jspm_packages|carthage|pods)/|(?:^|/)external/[^/]+/src/|(?:^|/)deps/[^/]+/"
GENERATED = r"(?:^|/)(?:__generated__|generated|autogen|\.generated)/|\.pb(?:\.[a-z]+)?\.[a-z]+$|_pb2(?:_grpc)?\.pyi?$|\.gen(?:erated)?\.[a-z]+$|\.designer\.[a-z]+$|\.g\.(?:dart|cs)$|\.freezed\.dart$|(?:^|/)zz_generated[._]|_generated\.[a-z]+$|\.g4\.[a-z]+$"
MINIFIED = r"[.-]min\.(?:js|css|mjs)$|\.bundle\.(?:js|css)$|\.chunk\.(?:js|css)$|(?:^|/)dist/.*\.(?:js|css)$|\.(?:js|css)\.map$"
PLACES = {"lock": LOCK_FILES, "vendored": VENDORED, "generated": GENERATED, "minified": MINIFIED}


def place(path: Column) -> Column:
    """What the path alone says: lock, vendored, generated or minified; NULL if nothing."""
    low = F.lower(path)
    verdict = F.lit(None).cast("string")
    for kind, pattern in reversed(PLACES.items()):
        verdict = F.when(low.rlike(pattern), kind).otherwise(verdict)
    return F.when(low.rlike(r"\.(?:md|rst|txt|adoc|markdown)$"), F.lit(None)).otherwise(verdict)


# -------------------------------------------------------------------- notices
# Wordings by which tools mark their output and projects their copies.
NOTICES = {
    "generated": re.compile(
        r"(?i)@generated\b|<auto-?generated>|\bcode generated by\b|\bauto-?generated (?:from|by|file)\b|^\W*generated (?:file|code|by|from)\b"
        r"|\b(?:file|code) (?:was |is )?(?:automatically|auto-?) ?(?:produced|generated|created)\b|\b(?:file|code) (?:was |is )generated\b"
        r"|\bmachine[- ](?:written|generated)\b|\bautomatisch (?:erzeugt|generiert|erstellt)\b|\bfichier (?:produit|généré|créé) (?:par|automatiquement)\b"
        r"|\b(?:archivo|fichero|código) (?:generado|producido|creado) (?:por|automáticamente)\b|\bgenerado automáticamente\b"
        r"|\bregenerate with\b|\bedits (?:will be|get) overwritten\b|\bmanual changes will be lost\b|\bdo not (?:edit|modify) by hand\b|\bDO NOT EDIT\b(?-i:\.|$)"
    ),
    "vendored": re.compile(
        r"(?i)\bvendored (?:copy|from)\b|\bthird[- ]party code\b|\bimported verbatim\b|\bbundled unmodified\b|\bcopied (?:verbatim )?from (?:the )?\S+ (?:project|v?\d)"
        r"|\bunmodified copy\b|\bupstream sources? live\b|\bchanges belong upstream\b|\bfremdcode\b|\bcode tiers\b|\bcódigo de terceros\b|\bübernommen aus\b|\bcopie conforme\b"
    ),
}
_COMMENT = re.compile(r"""\s*(//|#|/\*|\*|--|<!--|;|%|\"{3}|'{3})""")
_CLOSE = {"/*": "*/", "<!--": "-->", '"' * 3: '"' * 3, "'" * 3: "'" * 3}
_AT = re.compile(r"@@ -\S+ \+(\d+)")
_EDGE = re.compile(r"/\*|\*/\s*$")


def _inside(lines: list[str], at: int) -> bool:
    """Whether the hunk at ``at`` starts within a block comment: it shows the end of one before a beginning."""
    start = _AT.match(lines[at])
    if not start or int(start.group(1)) <= 1:
        return False
    for line in lines[at + 1 :]:
        if line.startswith("@@ "):
            return False
        if line[0] != "-" and (edge := _EDGE.search(line, 1)):
            return edge.group() != "/*"
    return False


def notice(lines: list[str]) -> str | None:
    """What the comments before the first line of code say.

    Removed lines are passed over, block comments followed to their end, and
    however long the comments are, all of them are read.
    """
    close = None
    for at, line in enumerate(lines):
        if line.startswith("@@ "):
            close = "*/" if _inside(lines, at) else None
            continue
        if line[:1] in ("-", "\\") or not line.strip("+- \t"):
            continue
        if line[:1] not in ("+", " "):
            return None
        rest = line[1:]
        while rest.strip():
            begun = 0
            if close is None:
                mark = _COMMENT.match(rest)
                if not mark:
                    return None
                close, begun = _CLOSE.get(mark.group(1)), mark.end()
            stop = rest.find(close, begun) if close else -1
            said = rest if stop < 0 else rest[: stop + len(close)]
            for kind, pattern in NOTICES.items():
                if pattern.search(said):
                    return kind
            if stop < 0:
                break
            rest, close = rest[len(said) :], None
    return None


# ---------------------------------------------------------------------- names
A = 29  # boundary, 26 letters in either case, digit, underscore
_CLASS = np.zeros(256, dtype=np.int64)
for _i in range(26):
    _CLASS[ord("a") + _i] = _CLASS[ord("A") + _i] = _i + 1
_CLASS[48:58] = 27
_CLASS[ord("_")] = 28


def _codes(body: str) -> np.ndarray:
    return _CLASS[np.frombuffer(f"\n{body}\n\n".encode(), dtype=np.uint8)]


def trigrams(x: np.ndarray) -> np.ndarray:
    """Codes of the trigrams that end inside or just behind a name."""
    a, b, c = x[:-2], x[1:-1], x[2:]
    return (a * A * A + b * A + c)[(b > 0) | (c > 0)]


BACKOFF = 20.0  # how many occurrences of a context the pooled model weighs against a language's own
RUN = 10  # names in the run whose cross-entropy is taken
SPAN = 50  # names in the moving window of diversity
FOREIGN = 0.2  # bits per character by which another language must fit better
CHARACTERS = 100  # trigrams from which on styles are compared; shorter files say too little


NOTHING = (0.0, 0.0, 1.0, 0, 0.0, 0.0)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the names among the codes of a text start and stop."""
    inside = x > 0
    return np.flatnonzero(inside[1:] & ~inside[:-1]) + 1, np.flatnonzero(inside[:-1] & ~inside[1:]) + 1


def mangled_at_sight(x: np.ndarray) -> bool:
    """Whether a third of the names have one letter. Such files train no model, whatever the models say later."""
    start, stop = _runs(x)
    return len(start) > 0 and float(((stop - start == 1) & (x[start] < 27)).mean()) >= 1 / 3


ENDLESS = 40  # characters from which on a word is no name a model could learn


def without_endless(x: np.ndarray) -> np.ndarray:
    start, stop = _runs(x)
    long = stop - start >= ENDLESS
    if long.any():
        x = x.copy()
        for a, b in zip(start[long], stop[long]):
            x[a:b] = 0
    return x


class Names:
    """Cost in bits of every trigram under the models of the languages; ``other`` is the pooled model.

    A language seen little leans on the pooled model, so that it neither finds
    everything strange nor everything foreign.
    """

    def __init__(self, counts: dict[str, np.ndarray]) -> None:
        pooled = sum(counts.values(), np.zeros(A**3)).reshape(A * A, A) + 0.05
        pooled /= pooled.sum(axis=1, keepdims=True)
        self.langs = sorted(counts)
        self.cost = np.empty((len(self.langs) + 1, A**3), dtype=np.float32)
        for i, lang in enumerate(self.langs):
            own = counts[lang].reshape(A * A, A)
            self.cost[i] = -np.log2((own + BACKOFF * pooled) / (own.sum(axis=1, keepdims=True) + BACKOFF)).reshape(-1)
        self.cost[-1] = -np.log2(pooled).reshape(-1)

    def row(self, lang: str | None) -> int:
        return self.langs.index(lang) if lang in self.langs else -1

    def measure(self, lang: str | None, body: str, codes: np.ndarray) -> tuple[float, float, float, int, float, float]:
        """``entropy, foreign, diversity, names, number share, blob share`` of a file's lines; ``NOTHING`` without any word."""
        x = np.concatenate(([0], codes))
        a, b, c = x[:-2], x[1:-1], x[2:]
        keep = (b > 0) | (c > 0)
        grams, starts = (a * A * A + b * A + c)[keep], (b == 0)[keep]
        if not len(grams):
            return NOTHING
        at = self.row(lang)
        own = self.cost[at][grams]
        name = np.cumsum(starts) - 1
        size = np.bincount(name)
        per = np.bincount(name, own) / size
        upto = np.concatenate(([0.0], np.cumsum(per)))
        run = min(RUN, len(per))
        # a run shorter than RUN is filled up with names at two bits, the cost of ordinary ones
        entropy = (float((upto[run:] - upto[:-run]).max()) + 2.0 * (RUN - run)) / RUN
        foreign = 0.0
        if at >= 0 and len(grams) >= CHARACTERS:
            foreign = float(own.mean() - self.cost[:-1, grams].mean(axis=1).min())
        length = size - 1  # a name of n characters has n + 1 trigrams
        longest = float(length[length >= 24].sum() / length.sum())
        numbers = float((c[keep][starts] == 27).mean())
        # one endless name has no run; it is dear by itself
        if longest >= 0.4:
            entropy = max(entropy, float(per[length >= 24].max()))
        return entropy, foreign, diversity(body), len(per), numbers, longest


_DIGITS = re.compile(r"[0-9]+")
_WORDS = re.compile(r"\w+")


def diversity(body: str, span: int = SPAN) -> float:
    """Mean share of distinct names over all windows of ``span`` names, any number counting as the same.

    Files of fewer names are one window. The number of repeats is worked out
    from the distances between equal names, so long files cost no more per name.
    """
    seen: dict[str, int] = {}
    codes = np.array([seen.setdefault(w, len(seen)) for w in _WORDS.findall(_DIGITS.sub("0", body))], dtype=np.int64)
    n = len(codes)
    if not n:
        return 1.0
    span = min(span, n)
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    first, second = order[:-1][same], order[1:][same]
    windows = np.minimum(first, n - span) - np.maximum(second - span + 1, 0) + 1
    return 1.0 - float(np.maximum(windows, 0).sum()) / ((n - span + 1) * span)


# ------------------------------------------------------------------ the passes
_HEAD = re.compile(r"^diff --git a/(\S.*?) b/(\S.*?)$", re.M)
_HUNK = re.compile(r"^@@ .*$", re.M)


def files_of(patch: str) -> Iterator[tuple[str, list[str]]]:
    """``path, lines`` per file of a unified diff; lines keep their sign, of the headers only those of hunks stay."""
    heads = list(_HEAD.finditer(patch))
    for m, after in zip(heads, [*heads[1:], None]):
        block = patch[m.end() : after.start() if after else len(patch)]
        first = _HUNK.search(block)
        body = block[first.start() :] if first else ""
        yield m.group(2), [x for x in body.split("\n") if x]


def _written(lines: list[str]) -> str:
    return "\n".join(x[1:] for x in lines if x[0] != "-" and not x.startswith("@@ "))


_PLACES = [re.compile(p) for p in PLACES.values()]


def placed(path: str) -> bool:
    """Whether a path is prose or marks its file. Such files, those with a notice and those
    mangled at sight train no model, and no bound is taken from them."""
    low = path.lower()
    return low.rpartition(".")[2] in PROSE or any(p.search(low) for p in _PLACES)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = {lang: np.zeros(A**3, dtype=np.int64) for lang in CODES}
    for b in batches:
        for col in range(b.num_columns):
            for patch in b.column(col).to_pylist():
                for path, lines in files_of(patch or ""):
                    if (lang := language_of(path)) and not placed(path) and notice(lines) is None:
                        x = _codes(_written(lines))
                        if not mangled_at_sight(x):
                            total[lang] += np.bincount(trigrams(without_endless(x)), minlength=A**3)
    rows = [(lang, i, int(n[i])) for lang, n in total.items() for i in np.flatnonzero(n)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64()))],
        ["lang", "gram", "n"],
    )


def train(patches: DataFrame, columns: tuple[str, ...] = ("patch", "test_patch")) -> Names:
    """The models of all languages from every unsuspected diff; at most 29**3 counts per language reach the driver."""
    counted = (
        spread(patches.select(*columns))
        .mapInArrow(_train, "lang string, gram int, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    counts: dict[str, np.ndarray] = {lang: np.zeros(A**3, dtype=np.int64) for lang in CODES}
    for r in counted.collect():
        counts[r["lang"]][r["gram"]] = r["n"]
    return Names(counts)


MEASURES = (
    "repo string, number bigint, file_path string, lang string, noticed string, suspected boolean, entropy double,"
    " foreign double, diversity double, names bigint, numbers double, blob double"
)


def _measure(model: Names):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            repos, numbers = b.column(0).to_pylist(), b.column(1).to_pylist()
            for col in range(2, b.num_columns):
                for repo, number, patch in zip(repos, numbers, b.column(col).to_pylist()):
                    for path, lines in files_of(patch or ""):
                        if path.rpartition(".")[2].lower() in PROSE:
                            continue
                        lang, said, body = language_of(path), notice(lines), _written(lines)
                        x = _codes(body)
                        got = model.measure(lang, body, x)
                        seed = said is not None or placed(path) or mangled_at_sight(x)
                        # two decimals keep the histograms of the bounds small
                        values = (round(got[0], 2), got[1], round(got[2], 2), *got[3:])
                        out.append((repo, number, path, lang or "other", said, seed, *values))
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
            types += [pa.float64()] * 3 + [pa.int64()] + [pa.float64()] * 2
            names = [x.split()[0] for x in MEASURES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

    return run


LEAST_FILES = 100  # languages with fewer unsuspected files take the bounds of all together
DEAR = (0.95, 2.5)  # quantile of the entropy, and how many times its distance from the median the bound lies out
LOW = (0.05, 3.5)  # the same for the diversity


def bounds(measured: DataFrame) -> DataFrame:
    """``lang, dear, low`` per language, from exact quantiles of its unsuspected files.

    Quantiles are taken over histograms in steps of a hundredth. The row of a
    NULL language is that of all languages; no language is stricter than it.
    """
    own = measured.where("not suspected and names > 0 and lang != 'other'")

    def limit(column: str, far: float, times: float, name: str) -> DataFrame:
        held = own.groupBy("lang", column).agg(F.count("*").alias("n")).rollup("lang").agg(
            F.percentile(column, [0.5, far], F.col("n")).alias("q"), F.sum("n").alias("files")
        )
        return held.select("lang", "files", (F.col("q")[0] + times * (F.col("q")[1] - F.col("q")[0])).alias(name))

    dear, low = limit("entropy", *DEAR, "dear"), limit("diversity", *LOW, "low").drop("files")
    both = dear.alias("a").join(low.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang")))
    return both.where((F.col("a.files") >= LEAST_FILES) | F.col("a.lang").isNull()).select("a.lang", "dear", "low")


LEAST_NAMES = 12  # names from which on their diversity says something


def names_say() -> Column:
    """The verdict of the measures: data, minified, generated, vendored; NULL if the names look written here."""
    dear = F.col("entropy") > F.col("dear")
    low = (F.col("diversity") < F.col("low")) & (F.col("names") >= LEAST_NAMES)
    return (
        F.when(dear & (F.col("blob") >= 0.4), "data")
        .when(low & (F.col("numbers") >= 0.6), "data")
        .when(dear, "minified")
        .when(low, "generated")
        .when(F.col("foreign") > FOREIGN, "vendored")
    )


def changed_entries(enriched: DataFrame) -> DataFrame:
    """Distinct ``repository, pull_number, file_path`` of all changed files."""
    return (
        enriched.select(
            fold("repository").alias("repository"),
            F.col("number").alias("pull_number"),
            F.explode("changed_files").alias("file_path"),
        )
        .where(F.col("file_path").isNotNull() & (F.col("file_path") != ""))
        .distinct()
    )


def measured_files(patches: DataFrame, model: Names | None = None) -> DataFrame:
    """The measures of every file in the diffs; narrow, so written once and read twice."""
    narrow = patches.select(fold("repo").alias("repo"), F.col("pr_number").cast("bigint"), "patch", "test_patch")
    return materialize(spread(narrow).mapInArrow(_measure(model or train(patches)), MEASURES), "files")


def judged_files(enriched: DataFrame, patches: DataFrame, model: Names | None = None) -> DataFrame:
    """``repository, pull_number, file_path, kind, by`` per changed file; NULL kind means hand-written.

    ``by`` says what decided: names (the models), notice or place. Diffs are
    found by repository (trimmed, lower case) and number; files without one
    are judged by their place alone. Prose files always count as hand-written,
    NULL and empty file lists have no entries, and repeated rows count once.
    """
    measured = measured_files(patches, model)
    limits = {r["lang"]: (r["dear"], r["low"]) for r in bounds(measured).collect()}  # a row per language

    def limit(at: int, strictest) -> Column:
        every = limits[None][at] if None in limits else None
        out = F.lit(every).cast("double")  # NULL in an empty table, where nothing is compared with it
        for lang, own in limits.items():
            if lang is not None:
                out = F.when(F.col("lang") == lang, F.lit(strictest(own[at], every))).otherwise(out)
        return out

    judged = (
        measured.withColumns({"dear": limit(0, max), "low": limit(1, min)})
        .withColumn("said", names_say())
        .where("said is not null or noticed is not null")
        .withColumn("verdict", F.struct(
            F.when(F.col("said").isNotNull(), "names").otherwise("notice").alias("by"), F.coalesce("noticed", "said").alias("kind")
        ))
    )
    seen = judged.groupBy(F.col("repo").alias("repository"), F.col("number").alias("pull_number"), "file_path").agg(
        F.min("verdict").alias("verdict")
    )
    at = place(F.col("file_path"))
    return changed_entries(enriched).join(seen, ["repository", "pull_number", "file_path"], "left").select(
        "repository",
        "pull_number",
        "file_path",
        F.coalesce("verdict.kind", at).alias("kind"),
        F.coalesce("verdict.by", F.when(at.isNotNull(), "place")).alias("by"),
    )


def hand_written(enriched: DataFrame, patches: DataFrame) -> DataFrame:
    """The changed files that remain."""
    return judged_files(enriched, patches).where("kind is null").drop("kind", "by")
