"""Problem 10: pages of repeated keywords, link lists and tags.

A text is cut into segments (lines, and sentences inside them). Segments whose
share of function words reaches the norm of their language are sentences;
fenced code is neither. The rest is weighed by the positive signs of spam: link
text, separator density, and top words, n-grams and lines that keep coming
back. A document is spam if most of its words lie in such segments.

Function words of four languages are listed. Those of any other language are
learned: the short words that a share of its documents hold, from all of them.
A language with too few documents for that has none; there a segment must look
like a list by its separators, links and repeats alone, as always, and in
addition must not read like a sentence (end like one, with few separators).

One pass over the texts leaves a histogram of words by function-word share for
every document. Summed by language it calibrates where sentences begin; the
verdict then needs the narrow features only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import materialize, spread

# Function words of the four languages of the corpus. Left out on
# purpose are those that also occur inside search phrases (no, me, top, vs).
FUNCTION_WORDS = frozenset(
    """
    a about after all an and any are as at be because been before but by can could did do does each even for from had
    has have how i if in into is it its no_ nobody not now of on only or our should since so some such than that the
    their them then there they this those to twice under until us used was we were what when where whenever which while
    who why will with without would you your
    aber als am an auf aus bei beim bis da damit dann das dass dem den der des die diese dieser doch durch ein eine einem
    einen einer eines er erst es für hat haben hinter ich ihm ihn im ist kein keinen man mehr mit nach nicht noch nun nur
    ob oder ohne sehr sich sie sind sobald so über um und unter vom von vor war was wenn wie wir wird wurde zu zum zur
    au aux avec ce ces cet cette chez comme dans de depuis des dès dont du elle en entre est et eu il ils je la le les
    leur lit lorsque mais ne nous ou où par pas plus pour puis qu que qui reste rien sans se ses si son sont sous sur
    tout très un une vers vous
    al ante aún como con cuando de del desde donde el ella en entre era es esta este esto fue ha hace hasta la las lo los
    más muy nada ni os para pero por porque queda que quien se ser si sido sin sobre solo son su sus tras un una unas
    unos y ya
    """.split()
)

LISTED = ("en", "de", "fr", "es", "und")  # und: documents of no known language are read in all four
LEARN_DOCS = 30  # documents from which on a language's function words are learned
LEARN_SHARE = 0.3  # share of its documents that must hold such a word
SHORT = 4  # and its letters at most; scripts without spaces between words have none
BINS = 20
PART = 0.4  # of a language's median share, from which segments count as sentences
MAJORITY = 0.5
WORD = re.compile(r"[^\W_]+", re.UNICODE)
FENCE = re.compile(r"^\s*(```|~~~)")
BREAK = re.compile(r"(?<=[.!?])\s+")
URL = re.compile(r"(?:https?://|www\.)[^\s)\]>]+")
LINK = re.compile(r"\[([^\[\]\n]*)\]\([^)\s]*\)")
ANCHOR = re.compile(r"<a\s[^>]*>(.*?)</a>", re.IGNORECASE)
TAG = re.compile(r"</?[A-Za-z][^<>]*>")
CAPITALS = re.compile(r"[^\W\d_a-z]{2}")
SEPARATOR = re.compile(r"[|;,/#•·>]")


def _segments(text: str) -> Iterator[tuple[str, bool]]:
    code = False
    for line in text.split("\n"):
        if FENCE.match(line):
            code = not code
            continue
        if code:
            yield line, True
            continue
        for part in BREAK.split(line):
            if part.strip():
                yield part, False


def _links(seg: str) -> tuple[list[str], list[str], str]:
    """Link texts, bare addresses, and the segment without markup; most segments have none of it."""
    links: list[str] = []
    rest = plain = seg
    if "](" in seg:
        links = LINK.findall(seg)
        rest, plain = LINK.sub(" ", seg), LINK.sub(r" \1 ", seg)
    if "<" in seg:
        links += ANCHOR.findall(seg)
        rest, plain = TAG.sub(" ", rest), TAG.sub(" ", plain)
    if "://" in plain or "www." in plain:
        return links, URL.findall(rest), URL.sub(" ", plain)
    return links, [], plain


SENTENCE_END = re.compile(r"[.!?。！？…][\"'”»)\]]*\s*$")


def features(text: str, function_words: frozenset[str] | None = FUNCTION_WORDS) -> tuple[list[int], list[int], int]:
    """Words by bin of function-word share, the suspicious ones among them by bin, and all words.

    The bins hold words outside code; the last value counts code too. Segments
    with a share of ``PART`` or more lie above any language's bar (which is at
    most that part of a median), so their signs of spam need no weighing.
    """
    words_at, bad_at, total = [0] * BINS, [0] * BINS, 0
    rows, lines, grams, heads = [], Counter(), Counter(), Counter()
    for seg, code in _segments(text):
        links, bare, plain = _links(seg)
        words = WORD.findall(plain.lower())
        n = len(words) + len(bare)
        total += n
        if code or not n:
            continue
        if function_words is None:  # nothing is known of the language
            written = not links and not bare and SENTENCE_END.search(plain) and len(SEPARATOR.findall(plain)) < 0.2 * max(n, len(plain) / 6)
            hits = n if written else 0
        else:
            hits = sum(map(function_words.__contains__, words))
            if hits and CAPITALS.search(plain):  # a code in capitals (DEN-204A) is no article
                hits -= sum(len(c) > 1 and c.isupper() and c.lower() in function_words for c in WORD.findall(plain))
        share = hits / n
        if share >= PART:
            words_at[min(BINS - 1, int(share * BINS))] += n
            continue
        lines[plain.strip().lower()] += 1
        if share < 0.3:
            grams.update(zip(words, words[1:]))
            heads.update(words)
        rows.append((plain, words, links, bare, n, share))
    for plain, words, links, bare, n, share in rows:
        at = min(BINS - 1, int(share * BINS))
        words_at[at] += n
        linked = len(bare) + sum(len(WORD.findall(x)) for x in links)
        pairs = list(zip(words, words[1:]))
        again = sum(grams[p] > 2 for p in pairs) / len(pairs) if pairs else 0.0
        common = sum(heads[w] > 3 for w in words) / n
        parts = len(SEPARATOR.findall(plain))
        if share < 0.3 and parts >= 5 and again >= 0.5 and parts >= 0.1 * n:
            at = 0  # a list of phrases stays one even if each holds a function word
        if (
            linked >= 0.5 * n
            or (parts >= 2 and parts >= 0.2 * n)
            or (lines[plain.strip().lower()] > 2 and n > 1)
            or again >= 0.3
            or (common >= 0.6 and n > 2)
        ):
            bad_at[at] += n
    return words_at, bad_at, total


OUT = "doc_id bigint, lang string, words_at array<int>, bad_at array<int>, words bigint"


def _pass(learned: dict[str, frozenset[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, langs, texts = (b.column(i).to_pylist() for i in range(3))
            got = [features(t or "", FUNCTION_WORDS if x in LISTED else learned.get(x)) for x, t in zip(langs, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(langs, pa.string()),
                    pa.array([g[0] for g in got], pa.list_(pa.int32())),
                    pa.array([g[1] for g in got], pa.list_(pa.int32())),
                    pa.array([g[2] for g in got], pa.int64()),
                ],
                ["doc_id", "lang", "words_at", "bad_at", "words"],
            )

    return run


def _short_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[tuple[str, str]] = Counter()
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held.update((lang, w) for w in {w for w in WORD.findall((text or "").lower()) if len(w) <= SHORT and w.isalpha()})
    rows = list(held.items())
    columns = ([k[0] for k, _ in rows], [k[1] for k, _ in rows], [n for _, n in rows])
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])


def learned_words(narrow: DataFrame) -> dict[str, frozenset[str]]:
    """The function words of every language that is not listed and has documents enough.

    Languages are codes of two or three letters, so their counts fit the driver;
    texts are read only if there is such a language. A word counts if at least
    a share of ``LEARN_SHARE`` of the documents hold it, so a language has no
    more of them than a document has short words, divided by that share.
    """
    per = narrow.where(~F.col("lang").isin(*LISTED)).groupBy("lang").agg(F.count("*").alias("n")).collect()
    docs = {r["lang"]: r["n"] for r in per if r["n"] >= LEARN_DOCS}
    if not docs:
        return {}
    other = narrow.where(F.col("lang").isin(*docs)).select("lang", "text")
    counted = other.mapInArrow(_short_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    least = reduce(lambda c, kv: F.when(F.col("lang") == kv[0], F.lit(LEARN_SHARE * kv[1])).otherwise(c), docs.items(), F.lit(None).cast("double"))
    out: dict[str, set[str]] = {}
    for r in counted.where(F.col("n") >= least).collect():
        out.setdefault(r["lang"], set()).add(r["word"])
    return {k: frozenset(v) for k, v in out.items()}


def language(c: Column | str) -> Column:
    """The primary subtag of a language code; unknown ones share ``und``."""
    c = F.col(c) if isinstance(c, str) else c
    tag = F.lower(F.regexp_extract(F.trim(c), r"^([A-Za-z]{2,3})(?:[-_]|$)", 1))
    return F.coalesce(F.nullif(tag, F.lit("")), F.lit("und"))


def page_features(documents: DataFrame) -> DataFrame:
    """Per document its language and word histograms. NULL and empty texts have no words."""
    narrow = documents.select(F.col("doc_id").cast("bigint"), language("lang").alias("lang"), F.col("text"))
    return spread(narrow).mapInArrow(_pass(learned_words(narrow)), OUT)


def sentence_norms(features_: DataFrame, part: float = PART) -> DataFrame:
    """Per language the bin from which segments count as sentences.

    It lies at ``part`` of the language's word-weighted median function-word
    share (segments without any function word aside), so a language that uses
    fewer function words gets a lower bar.
    """
    at = features_.select("lang", F.posexplode("words_at").alias("bin", "n")).where("bin > 0")
    per = at.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    half = (
        per.groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("h"), F.sum("n").alias("all"))
        .withColumn("cum", F.expr("transform(h, (x, i) -> aggregate(slice(h, 1, i + 1), 0L, (a, y) -> a + y.n))"))
        .withColumn("at", F.expr("filter(sequence(0, size(h) - 1), i -> cum[i] * 2 >= all)[0]"))
    )
    norm = F.greatest(F.lit(1), F.floor(F.expr("h[at].bin") * F.lit(part)).cast("int"))
    return half.select("lang", norm.alias("norm"))


def keyword_pages(documents: DataFrame, majority: float = MAJORITY) -> DataFrame:
    """``doc_id, words, spam_words, spam`` for every document.

    A document without words is never spam. ``doc_id`` may repeat if it repeats
    in the input.
    """
    seen = materialize(page_features(documents), "pages")
    norms = sentence_norms(seen)
    judged = seen.join(F.broadcast(norms), "lang", "left")  # one row per language code
    low = F.expr("slice(bad_at, 1, coalesce(norm, 1))")
    spam_words = F.aggregate(low, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return judged.select("doc_id", "words", spam_words.alias("spam_words")).withColumn(
        "spam", (F.col("words") > 0) & (F.col("spam_words") > F.lit(majority) * F.col("words"))
    )
