"""Problem 2: personal data in free text, by information-theoretic sanitisation.

Shapes only propose. Everything that looks like a mail address, a number, a
street or a name of at least two words is a proposal with terms: its words or
its digits' shape, and the words before and behind it. How strongly a term
gives a person away is estimated from the whole corpus: its disclosure is the
information that its co-occurrence with protected entities adds to a
proposal's prior,

    logit P(protected | term) - logit P(protected)

Protected entities are at first the proposals beyond doubt (both name parts
known, a labelled or international number, mail, street); then the
probabilities found replace them, so that what stands beside known names
becomes known, and names nobody listed are found by where they stand. A
proposal whose terms disclose more than the threshold is removed for a typed
placeholder; one between the lower threshold and it is generalised (names to
initials, digits to #).

Long numbers that fit no personal shape take part as background: a number
behind *Build* discloses nothing, because what stands there seldom does.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import materialize, spread

KINDS = ("email", "phone", "id_number", "street_address", "person_name")
THRESHOLD = 0.5  # probability of a protected entity from which on a proposal is removed
GENERAL = 0.3  # and from which on it is generalised
ROUNDS = 3  # rounds of estimating disclosures
WEIGHT = 2.0  # pseudo-occurrences of a term's prior
LISTED, UNLISTED = 0.8, 0.25  # prior of a name's word that is, or is not, among the known parts
SHAPED = 0.9  # prior of a number of personal shape

# ---------------------------------------------------------------- shapes
_AT = r"(?:@|\s?[\(\[\{]\s?(?:at|AT|ät|arroba)\s?[\)\]\}]\s?|\s(?:AT|at)\s(?=\S+\s(?:DOT|dot)\s))"
_DOT = r"(?:\.|\s?[\(\[\{]\s?(?:dot|DOT|punkt|punto|point)\s?[\)\]\}]\s?|\s(?:DOT|dot)\s)"
EMAIL = regex.compile(
    rf"(?<![\w.+%/@-])[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}._%+'-]*{_AT}(?:[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}-]*[\p{{L}}\p{{N}}])?{_DOT})+\p{{L}}{{2,}}(?![\w@-]|{_DOT}[\p{{L}}\p{{N}}])"
)
# What every match of EMAIL holds, whatever stands before it.
AT_SIGN = regex.compile(r"@|[\(\[\{]\s?(?:at|AT|ät|arroba)\s?[\)\]\}]|\s(?:AT|at)\s")
REMOTE = regex.compile(r"(?:\w+://\S*$)|(?:\bgit$)")

_P = r"(?<![\w.+/:#-])"
_E = r"(?![\w]|[-./:]\d)"
# National and international ways to write a phone number.
_PHONES = (
    r"\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}",
    r"\+\d{10,14}",
    r"\+\d{1,3}(?:[ .\-/]\d{1,5}){2,6}",
    r"00\d{2}(?:[ .-]\d{1,8}){2,6}",
    r"\(\d{3}\) ?\d{3}[-. ]\d{4}",
    r"[2-9]\d{2}(?:-\d{3}-|\.\d{3}\.| \d{3} )\d{4}",
    r"0\d{1,4}/\d{5,9}",
    r"0\d{2,4} \d{3,4} \d{4}",
    r"0[1-9](?:(?: \d{2}){4}|(?:\.\d{2}){4})",
)
_PHONE_BODY = "(?:" + "|".join(f"{x}{_E}" for x in _PHONES) + ")"
PHONE = regex.compile(rf"(?=[+(\d]){_P}{_PHONE_BODY}")
PHONE_HERE = regex.compile(_PHONE_BODY)
# What every number holds: the shortest that _PHONES take has 6 characters, a labelled one 7 digits.
DIALLED = regex.compile(r"[+(\d][\d ()./-]{5,}")
PHONE_LABEL = regex.compile(r"(?i)(?:\btel\.?|\bphone|\btelefon|\btéléphone|\bteléfono) ?[:=]? ?(?=[+(\d])")
PHONE_LOOSE = regex.compile(r"\+?[\d(][\d ()./-]{6,18}\d(?!\w)")

_LABEL = (
    r"(?:ssn|social security (?:number|no\.?)|nir|n[°ºo]\.? de sécurité sociale|numéro de sécurité sociale"
    r"|steuer-?id(?:nr\.?|entifikationsnummer)?|steuernummer|dni|nie|nif|ni (?:number|no\.?)|national insurance (?:number|no\.?)|nino"
    r"|passport(?: (?:number|no\.?))?|reisepass(?:nummer|nr\.?| nr\.?)?|pasaporte(?: n[°º.o]*)?|passeport(?: n[°º.o]*)?|tax id|tin|ausweis(?:nummer|nr\.?)?)"
)
ID_LABELLED = regex.compile(
    rf"(?i)(?<!\w){_LABEL}\s{{0,2}}[:=#]?\s{{0,2}}((?:[A-Z]{{1,3}} ?)?\d(?:[ .-]?\d){{4,14}}(?:[ -]?[A-Z])?|[A-Z]{{1,2}} ?\d[\d ]{{5,14}}\d(?: ?[A-Z])?)(?!\w)"
)
ID_SHAPE = regex.compile(
    r"(?<![\w.+/:#-])(?:\d{3}-\d{2}-\d{4}|\d{8}-?[A-HJ-NP-TV-Z]|[XYZ]\d{7}[A-Z]|[A-Z]{2} \d{2} \d{2} \d{2} [A-D]|[12] \d{2} (?:0[1-9]|1[0-2]) \d{2} \d{3} \d{3} \d{2}|\d{2} \d{3} \d{3} \d{3})(?![\w]|[-./]\d| \d)"
)
# Any long number, to learn what stands before those that belong to nobody.
LONG_NUMBER = regex.compile(r"(?<![\w.])\d(?:[\d ()./-]*\d)?(?!\w)")

_CAP = r"\p{Lu}[\p{L}'’-]*\p{Ll}[\p{L}'’-]*"
_STREET_EN = r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Court|Ct|Terrace|Ter|Boulevard|Blvd|Place|Pl|Square|Sq|Way|Close|Crescent|Row|Parkway|Pkwy|Highway|Hwy)"
STREET = regex.compile(
    "|".join(
        (
            rf"(?<![\w.,-])\d{{1,5}}\p{{Ll}}?,? (?:[NSEW]{{1,2}}\.? |North |South |East |West )?(?:{_CAP} ){{1,3}}{_STREET_EN}\b\.?(?=[\s,;|/)]|$)(?<!\.)",
            r"(?<![\w.,-])\d{1,4}(?: (?:bis|ter|quater)| ?[a-d])?,? (?:rue|avenue|av\.|boulevard|bd|quai|place|chemin|allée|impasse|cours|route|passage|square) (?:(?:de la|de l['’]|des|du|de|d['’]) ?)?"
            + rf"{_CAP}(?:[ -]{_CAP})?",
            rf"(?<!\w)(?:(?:Am|An der|Auf der|Alte[rs]?|Neue[rs]?|Große|Kleine) )?{_CAP[:-1]}?(?:straße|strasse|str\.|weg|allee|platz|gasse|ring|ufer|damm|steig|chaussee)[ ]\d{{1,4}} ?[a-h]?(?!\w|[.,]?\d)",
            rf"(?<!\w)(?:Am|An der|Auf der|Alte|Neue|Große|Kleine) {_CAP} \d{{1,4}}[a-h]?(?=[,;|/ ]+\d{{5}} )",
            rf"(?<!\w)(?:Calle|Avenida|Avda\.|Paseo|Plaza|C/|Camino|Ronda|Travesía|Carrer|Carretera)(?: (?:de la|de los|de las|del|de))? {_CAP}(?: {_CAP})?,? (?:n[°º]\.? ?)?\d{{1,4}} ?[a-h]?(?!\w|[.,]?\d)",
        )
    )
)

# ---------------------------------------------------------------- names
_PART = r"(?i:van der |van den |van de |van |von der |von |de la |de los |de |del |della |di |du |da |dos |le |la |zu |ter |ten )"
_NAME1 = r"(?:\p{Lu}[’']\p{Lu}?[\p{L}]+|\p{Lu}\p{Ll}[\p{L}]*|\p{Lu}{2,})"
_NAME = rf"{_NAME1}(?:[-‐]{_NAME1})*"
FULL = rf"(?:{_NAME}(?: \p{{Lu}}\.)? {_PART}?{_NAME}|(?:{_PART})?{_NAME}, {_NAME}(?: \p{{Lu}}\.)?)"
CANDIDATE = regex.compile(rf"(?<![\p{{L}}\p{{N}}_@/`'’.-]|\p{{Lu}}\.)({FULL})(?![\p{{L}}\p{{N}}_(/`]|-\p{{L}}|\.\p{{L}})")
TERM = regex.compile(r"\p{Lu}[\p{L}’']*\p{L}")
TOKEN = regex.compile(r"[\p{L}\p{N}_'’]+|\n|[^\s\p{L}\p{N}_]")
FIRST_WORD = regex.compile(r"[\p{L}'’-]*")
CODE = regex.compile(r"`[^`\n]*`")


def _overlaps(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    return any(a < y and x < b for x, y in spans)


def _clean(text: str, a: int, b: int) -> tuple[int, int]:
    while b > a and text[b - 1] in " \t\r\n.,;:!?)]}>\"'":
        b -= 1
    while a < b and text[a] in " \t\r\n<[{\"'":
        a += 1
    return a, b


def shapes(text: str) -> list[tuple[int, int, str, bool]]:
    """Mail addresses, identity numbers, phones and street addresses: ``start, end, kind, beyond doubt``."""
    out: list[tuple[int, int, str, bool]] = []
    spans: list[tuple[int, int]] = []

    def add(a: int, b: int, kind: str, sure: bool) -> None:
        a, b = _clean(text, a, b)
        if b > a and not _overlaps(spans, a, b):
            spans.append((a, b))
            out.append((a, b, kind, sure))

    if AT_SIGN.search(text):
        for m in EMAIL.finditer(text):
            host = text[m.end() : m.end() + 2]
            local = regex.split(_AT, m.group(), maxsplit=1)[0]
            remote = local == "git" or (host[:1] == ":" and host[1:2] not in ("", " ", "\n")) or "://" in text[max(0, m.start() - 8) : m.start()]
            spans.append(m.span()) if remote else add(*m.span(), "email", True)
    for m in ID_LABELLED.finditer(text):
        add(*m.span(1), "id_number", True)
    for m in STREET.finditer(text):
        add(*m.span(), "street_address", True)
    for m in ID_SHAPE.finditer(text):
        add(*m.span(), "id_number", False)
    if DIALLED.search(text):
        for m in PHONE_LABEL.finditer(text):
            n = PHONE_HERE.match(text, m.end()) or PHONE_LOOSE.match(text, m.end())
            if n and 7 <= sum(c.isdigit() for c in n.group()) <= 15:
                add(*n.span(), "phone", True)
        for m in PHONE.finditer(text):
            add(*m.span(), "phone", text[m.start()] == "+")
    return out


def background(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Numbers of six digits or more that are no proposal."""
    out = []
    for m in LONG_NUMBER.finditer(text):
        if m.end() - m.start() >= 6 and sum(c.isdigit() for c in m.group()) >= 6 and not _overlaps(taken, *m.span()):
            out.append(m.span())
    return out


def norm(term: str) -> str:
    return term.casefold().replace("’", "'")


class Known:
    """The known name parts. Family names may hold particles; each of their words counts."""

    def __init__(self, parts: list[tuple[str, str]]) -> None:
        self.given = {norm(p) for p, k in parts if k == "given"}
        self.family = {norm(w) for p, k in parts if k == "family" for w in regex.split(r"[ -]", p) if w[:1].isupper()}


def names(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str, list[str]]]:
    """What might be a name: ``start, end, given, family words``.

    Every capitalised word may begin one, so proposals overlap: of *Thanks Anna
    Meier* both halves are proposed, and their disclosures tell which is one.
    """
    out = []
    code = [m.span() for m in CODE.finditer(text)] if "`" in text else []
    pos = 0
    while m := CANDIDATE.search(text, pos):
        a, b = m.span(1)
        pos = a + max(1, len(FIRST_WORD.match(text, a, b).group()))
        words = [norm(w) for w in TERM.findall(text, a, b) if len(w) > 1]
        if len(words) < 2 or _overlaps(taken, a, b) or _overlaps(code, a, b):
            continue
        flipped = "," in text[a:b]
        out.append((a, b, words[-1] if flipped else words[0], words[:-1] if flipped else words[1:]))
    return out


class Around:
    """The words before and behind a place, from the tokens of the whole text."""

    def __init__(self, text: str) -> None:
        spans = [(m.start(), m.end(), m.group()) for m in TOKEN.finditer(text)]
        self.starts = [s[0] for s in spans]
        self.words = ["0" if s[2][0].isdigit() else s[2].lower() for s in spans]

    def terms(self, a: int, b: int) -> list[tuple[str, str | None, float | None, float]]:
        i, j = bisect_left(self.starts, a), bisect_left(self.starts, b)
        left = ["^", "^", *self.words[max(0, i - 2) : i]][-2:]
        right = [*self.words[j : j + 2], "$", "$"][:2]
        return [
            (f"l2 {left[0]} {left[1]}", f"l1 {left[1]}", None, 1.0),
            (f"r2 {right[0]} {right[1]}", f"r1 {right[0]}", None, 1.0),
        ]


PASS = (
    "tbl string, rec_key string, uid bigint, uid2 bigint, pii_kind string, pii_text string, start int, stop int, family string,"
    " seed boolean, terms array<struct<term:string,parent:string,prior:double,weight:double>>"
)
_TERMS = pa.list_(
    pa.struct([("term", pa.string()), ("parent", pa.string()), ("prior", pa.float64()), ("weight", pa.float64())])
)
_DIGIT = regex.compile(r"\d")


def proposals(text: str, known: Known) -> list[tuple[str | None, int, int, str, bool, list[tuple]]]:
    """``kind, start, end, family, beyond doubt, terms`` of everything in a text that might be personal; kind None is background."""
    found = shapes(text)
    taken = [(a, b) for a, b, _, _ in found]
    said = names(text, taken)
    long = background(text, taken)
    if not (found or said or long):
        return []
    around = Around(text)
    out: list[tuple[str | None, int, int, str, bool, list[tuple]]] = []
    for a, b, kind, sure in found:
        if kind in ("email", "street_address"):
            out.append((kind, a, b, kind, sure, [(f"s {kind}", None, SHAPED, 1.0)]))
        else:
            shape = _DIGIT.sub("0", text[a:b])
            out.append((kind, a, b, "number", sure, [(f"s {kind} {shape}", None, SHAPED, 1.0), *around.terms(a, b)]))
    for a, b in long:
        out.append((None, a, b, "number", False, around.terms(a, b)))
    for a, b, given, family in said:
        sure = given in known.given and any(w in known.family for w in family)
        own = [(f"g {given}", None, LISTED if given in known.given else UNLISTED, 1.0)]
        own += [(f"f {w}", None, LISTED if w in known.family else UNLISTED, 1.0 / len(family)) for w in family]
        out.append(("person_name", a, b, "name", sure, [*own, *around.terms(a, b)]))
    return out


def scan(parts: list[tuple[str, str]]):
    """The pass over all texts, as a ``mapInArrow`` function: one row per proposal."""
    known = Known(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tbl, key, u, v, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if text:
                    for kind, a, b, family, sure, terms in proposals(text, known):
                        rows.append((tbl, key, u, v, kind, text[a:b], a, b, family, sure, [dict(zip(("term", "parent", "prior", "weight"), t)) for t in terms]))
            types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), _TERMS]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], NAMES)

    return run


NAMES = "tbl rec_key uid uid2 pii_kind pii_text start stop family seed terms".split()


# ---------------------------------------------------------------- disclosure
def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(0.005)), F.lit(0.995))
    return F.log(p / (1 - p))


COMMON = 10_000  # a term is common if more than one in so many features has it; there are no more such terms than this


def _with_counts(features: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """``features`` with the counts of their terms.

    Common terms, at most ``COMMON``, are broadcast; the rest is joined by term
    with no key that holds more than a small share of the rows.
    """
    c = counts.withColumnRenamed("family", "_f").withColumnRenamed("term", "_t")
    common = F.col("n") * COMMON >= F.lit(total)
    on = (F.col("family") == F.col("_f")) & (F.col("term") == F.col("_t"))
    near = features.join(F.broadcast(c.where(common)), on, "left").drop("_f", "_t")
    rest = near.where("n is null").select(features.columns)
    return near.where("n is not null").unionByName(rest.join(c.where(~common), on).drop("_f", "_t"))


def disclosures(proposed: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pid, p``: the probability that a proposal is a protected entity, from the disclosures of its terms.

    A term's share of protected proposals leaves the proposal itself out, and
    leans on its prior where the corpus holds it seldom: words on whether they
    are listed, two words of context on the nearer one, that on the family.
    """
    # a number of personal shape is open at first, everything else without seed no entity
    first = F.when(F.col("seed"), 1.0).when((F.col("family") == "number") & F.col("pii_kind").isNotNull(), 0.5).otherwise(0.0)
    state = proposed.select("pid", "family", first.alias("q"), "terms")
    total = proposed.select(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    for _ in range(rounds):
        means = {r["family"]: r["m"] for r in state.groupBy("family").agg(F.avg("q").alias("m")).collect()}  # a row per family
        pi = F.lit(0.5)
        for family, m in means.items():
            pi = F.when(F.col("family") == family, F.lit(min(max(m, 0.1), 0.9))).otherwise(pi)
        features = state.select("pid", "family", "q", F.explode("terms").alias("t"))
        flat = features.select("pid", "family", "q", "t", "t.term", "t.parent", "t.prior", "t.weight")
        own = flat.groupBy("family", "term", "parent").agg(F.count("*").alias("n"), F.sum("q").alias("s"))
        # a term has one parent, so the counts of parents are sums of those of their terms
        up = own.where("parent is not null").groupBy("family", "parent").agg(F.sum("n").alias("n_up"), F.sum("s").alias("s_up"))
        counts = materialize(own.join(up, ["family", "parent"], "left").drop("parent"), "pii-terms")
        told = _with_counts(flat, counts, total)

        def share(n: str, s: str, prior: Column) -> Column:
            return (F.greatest(F.col(s) - F.col("q"), F.lit(0.0)) + WEIGHT * prior) / (F.col(n) - 1 + WEIGHT)

        prior = F.when(F.col("parent").isNotNull(), share("n_up", "s_up", pi)).otherwise(F.col("prior"))
        bits = F.col("weight") * (_logit(share("n", "s", prior)) - _logit(pi))
        judged = told.withColumn("bits", bits).groupBy("pid", "family").agg(F.sum("bits").alias("bits"), F.collect_list("t").alias("terms"))
        q = F.least(F.round(1 / (1 + F.exp(-(F.col("bits") + _logit(pi)))), 6), F.lit(0.999999))
        state = materialize(judged.select("pid", "family", q.alias("q"), "terms"), "pii-odds")
    return state.select("pid", F.col("q").alias("p"))


def _keyed(texts: DataFrame) -> DataFrame:
    """The texts with 128 bits that tell rows of different key or text apart, NULL keys included."""
    cols = [F.col("tbl").cast("string").alias("tbl"), F.col("rec_key").cast("string").alias("rec_key")]
    key = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("tbl", "rec_key", "text")]
    return texts.select(*cols, F.xxhash64(F.lit(1), *key).alias("uid"), F.xxhash64(F.lit(2), *key).alias("uid2"), F.col("text").cast("string"))


def _apart(found: DataFrame) -> DataFrame:
    """Of overlapping names of one text the likelier, then the longer, then the first; other kinds never overlap."""
    best = F.struct(-F.round("p", 3), F.col("start") - F.col("stop"), "start", "stop", "pid")
    per = found.where("family = 'name'").groupBy("uid", "uid2").agg(F.sort_array(F.collect_set(best)).alias("all"))
    none = F.array().cast(per.schema["all"].dataType)
    kept = F.aggregate(
        "all",
        none,
        lambda acc, x: F.when(F.exists(acc, lambda y: (x["start"] < y["stop"]) & (y["start"] < x["stop"])), acc).otherwise(F.concat(acc, F.array(x))),
    )
    names_ = per.select(F.explode(kept).alias("k")).select("k.pid")
    return found.where("family != 'name'").unionByName(found.join(names_, "pid", "left_semi"))


def judged(texts: DataFrame, name_parts: DataFrame, least: float) -> DataFrame:
    """Every proposal of at least probability ``least``: ``uid, uid2, tbl, rec_key, pii_kind, pii_text, start, stop, p``.

    A mention that repeats (the same row twice) counts once.
    """
    parts = [(r[0], r[1]) for r in name_parts.where("name_part is not null").select("name_part", "part_kind").collect()]
    seen = spread(_keyed(texts)).mapInArrow(scan(parts), PASS)
    pid = F.xxhash64("uid", "uid2", "start", "stop")
    proposed = materialize(seen.withColumn("pid", pid).dropDuplicates(["pid"]), "pii")
    found = proposed.where("pii_kind is not null").drop("terms").join(disclosures(proposed), "pid").where(F.col("p") >= F.lit(least))
    return _apart(found).select("uid", "uid2", "tbl", "rec_key", "pii_kind", "pii_text", "start", "stop", "p")


def find_pii(texts: DataFrame, name_parts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``tbl, rec_key, pii_kind, pii_text, start, stop`` for every piece of personal data.

    ``texts(tbl, rec_key, text)``; NULL and empty texts hold none. Offsets count
    code points. ``name_parts`` (a fixed list of known parts) goes to the tasks.
    """
    return judged(texts, name_parts, threshold).select("tbl", "rec_key", "pii_kind", "pii_text", "start", "stop")


def redact(text: Column, pieces: Column) -> Column:
    """``text`` with every piece (array of struct<start,stop,put>, sorted) replaced by what is put there."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        pieces,
        start,
        lambda acc, p: F.struct(
            p["stop"].alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, p["start"] - acc["at"]), p["put"]).alias("out"),
        ),
    )
    whole = F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(pieces) > 0, whole).otherwise(text)


def sanitize(texts: DataFrame, name_parts: DataFrame, threshold: float = THRESHOLD, general: float = GENERAL) -> DataFrame:
    """``tbl, rec_key, text`` with typed placeholders; texts without personal data as they were.

    What discloses less than ``threshold`` but at least ``general`` is
    generalised: names to their initials, numbers to their shape.
    """
    initials = F.regexp_replace("pii_text", r"(\p{L})[\p{L}'’.-]*", "$1.")
    rough = F.when(F.col("pii_kind") == "person_name", initials).otherwise(F.regexp_replace("pii_text", r"\d", "#"))
    put = F.when(F.col("p") >= F.lit(threshold), F.concat(F.lit("["), F.upper("pii_kind"), F.lit("]"))).otherwise(rough)
    pieces = (
        judged(texts, name_parts, min(threshold, general))
        .groupBy("uid", "uid2")
        .agg(F.sort_array(F.collect_set(F.struct("start", "stop", put.alias("put")))).alias("pieces"))
    )
    none = F.array().cast("array<struct<start:int,stop:int,put:string>>")
    return _keyed(texts).join(pieces, ["uid", "uid2"], "left").select(
        "tbl", "rec_key", redact(F.col("text"), F.coalesce("pieces", none)).alias("text")
    )
