import pytest

from millrace.llm import pii

PARTS = [("Hope", "given"), ("Mira", "given"), ("Jonas", "given"), ("Will", "given"), ("Tariwicking", "family"), ("O'Braelexez", "family"), ("de la Quilemdennay", "family")]
KNOWN = pii.Known(PARTS)


def kinds(text):
    return {(k, text[a:b]) for a, b, k, _ in pii.shapes(text)}


@pytest.mark.parametrize(
    "text, want",
    [
        ("mail a.b+ci@mail.x.example, please", {("email", "a.b+ci@mail.x.example")}),
        ("<AB@X.EXAMPLE>", {("email", "AB@X.EXAMPLE")}),
        ("at ab [at] mail [dot] x [dot] example now", {("email", "ab [at] mail [dot] x [dot] example")}),
        ("ab AT x-labs DOT example", {("email", "ab AT x-labs DOT example")}),
        ("ab (at) x.co.example", {("email", "ab (at) x.co.example")}),
        ("[me](mailto:ab@x.test)", {("email", "ab@x.test")}),
        ("git@forge.example:a/b.git and deploy@10.0.0.1 and pkg@1.2.3 and @handle", set()),
        ("Call +49 30 23125 923 or 030/23125293.", {("phone", "+49 30 23125 923"), ("phone", "030/23125293")}),
        ("(415) 555-0173; +1 (415) 555-0156; 303.555.0142", {("phone", "(415) 555-0173"), ("phone", "+1 (415) 555-0156"), ("phone", "303.555.0142")}),
        ("tel:+15125550194 01 99 00 01 14", {("phone", "+15125550194"), ("phone", "01 99 00 01 14")}),
        ("part no. 5729-92-118, port 3222-4071, took 1 780 828 or 8.412.928, v1.2.3, 2025-01-14 11:55, 10.1.2.3:80, build 2028822359", set()),
        ("SSN 983 33 4845, 975-36-2831", {("id_number", "983 33 4845"), ("id_number", "975-36-2831")}),
        ("Steuer-IdNr. 73 746 720 068; DNI: 50619973-D; NI number QQ 20 73 63 C", {("id_number", "73 746 720 068"), ("id_number", "50619973-D"), ("id_number", "QQ 20 73 63 C")}),
        ("passport no. ZK6663173 and n° de sécurité sociale 2 43 08 99 442 691 14", {("id_number", "ZK6663173"), ("id_number", "2 43 08 99 442 691 14")}),
        ("to 1340 N. Braarden Rd in 73493 X", {("street_address", "1340 N. Braarden Rd")}),
        ("Calizelweg 74, 92001 Y", {("street_address", "Calizelweg 74")}),
        ("111 bis quai des Ulormora, 1", {("street_address", "111 bis quai des Ulormora")}),
        ("Avenida de Braovtor, 124, 38780 V", {("street_address", "Avenida de Braovtor, 124")}),
        ("", set()),
    ],
)
def test_shapes(text, want):
    assert kinds(text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("Thanks Hope B. O'Braelexez yesterday", ["Thanks Hope", "Hope B. O'Braelexez"]),
        ("to Tariwicking, Jonas for it", ["Tariwicking, Jonas"]),
        ("an JONAS DE LA QUILEMDENNAY für", ["JONAS DE LA QUILEMDENNAY", "DE LA QUILEMDENNAY", "LA QUILEMDENNAY"]),
        ("Mme Zuri Tariwicking-Braelez hier", ["Mme Zuri", "Zuri Tariwicking-Braelez"]),
        ("`Hope Server` runs", []),
    ],
)
def test_every_capitalised_word_may_begin_a_name(text, want):
    assert [text[a:b] for a, b, _, _ in pii.names(text, [])] == want


def test_context_is_taken_from_the_whole_text():
    text = "x" * 50 + " approved   by " + "\t" * 300 + "Ann Bee" + " " * 300 + "yesterday ."
    a = text.index("Ann")
    (left, near, _, _), (right, _, _, _) = pii.Around(text).terms(a, a + 7)
    assert (left, near, right) == ("l2 approved by", "l1 by", "r2 yesterday .")


@pytest.mark.parametrize(
    "text, want",
    [
        ("anna (ät) firma.de", ("email", "anna (ät) firma.de")),
        ("ana{at}sitio.es", ("email", "ana{at}sitio.es")),
        ("ana [ arroba ] sitio.es", ("email", "ana [ arroba ] sitio.es")),
        ("ana\nat sitio DOT es", ("email", "ana\nat sitio DOT es")),
        ("Tel: 555-0123", ("phone", "555-0123")),
        ("030/2312", None),
        ("01/23125", ("phone", "01/23125")),
    ],
)
def test_a_piece_is_found_on_its_own(text, want):
    alone = kinds(text)
    assert alone == ({want} if want else set())
    assert alone <= kinds(text + " \n\nSee x@y.example, +49 30 23125 923, at noon.")


GIVEN, FAMILY = ("Mira", "Jonas", "Hope", "Will"), ("Tariwicking", "Quilemdennay", "Braelexez")


def corpus():
    """Known people in a few places, and capitalised words where nobody stands."""
    out = []
    for i, (g, f) in enumerate((g, f) for g in GIVEN for f in FAMILY):
        out += [f"Reported-by: {g} {f} (x@y.example)", f"It works. Contact {g} {f} for details.", f"Thanks {g} {f} for the review"]
        out += ["Hope Server handles it", "Will Gateway handles it", "Bad Gateway after 3 tries", f"Build 30355501{i:02d} took long", f"Call 303-555-01{i:02d} now"]
        out += [f"Desk tel: 303-555-02{i:02d} any time"]
    return out


UNCLEAR = [
    ("unlisted", "Contact Oluwaseun Adeyemi for details.", {("person_name", "Oluwaseun Adeyemi")}),
    ("family", "Nothing here. Mira Newbergsen (x@y.example) found it", {("person_name", "Mira Newbergsen"), ("email", "x@y.example")}),
    ("halves", "Thanks Anja Kowalczyk for the review", {("person_name", "Anja Kowalczyk")}),
    ("particle", "Reported-by: JONAS DE LA QUILEMDENNAY (z@y.example)", {("person_name", "JONAS DE LA QUILEMDENNAY"), ("email", "z@y.example")}),
    ("product", "Hope Server handles it", set()),
    ("service", "Mira Gateway handles it", set()),
    ("phone", "Call 303-555-0142 now", {("phone", "303-555-0142")}),
    ("none", None, set()),
    ("empty", "", set()),
]


def frames(spark, rows):
    df = spark.createDataFrame(rows, "tbl string, rec_key string, text string")
    parts = [(g, "given") for g in GIVEN] + [(f, "family") for f in (*FAMILY, "de la Quilemdennay")] + [(None, None)]
    return df, spark.createDataFrame(parts, "name_part string, part_kind string")


def test_disclosures_of_the_corpus_decide(spark):
    rows = [("t", f"c{i}", x) for i, x in enumerate(corpus())]
    df, parts = frames(spark, rows + [("t", k, x) for k, x, _ in UNCLEAR] + [("t", "phone", UNCLEAR[6][1]), (None, None, UNCLEAR[0][1])])
    got: dict = {}
    for r in pii.find_pii(df, parts).collect():
        got.setdefault(r["rec_key"], set()).add((r["pii_kind"], r["pii_text"]))
    assert {k: got.get(k, set()) for k, _, _ in UNCLEAR} == {k: want for k, _, want in UNCLEAR}
    assert got[None] == UNCLEAR[0][2]
    # ablations: nothing passes the highest threshold, and without the corpus nobody unlisted is found
    assert pii.find_pii(df, parts, threshold=1.0).count() == 0
    alone, _ = frames(spark, [("t", k, x) for k, x, _ in UNCLEAR if k in ("unlisted", "halves")])
    assert pii.find_pii(alone, parts).count() == 0
    assert pii.find_pii(df.limit(0), parts).count() == 0


def test_a_number_behind_what_precedes_other_numbers_is_kept(spark):
    rows = [("t", f"a{i}", f"order 77{i:03d}-1234-88 was sent and later order 88{i:03d}-4321-99") for i in range(60)]
    rows += [("t", f"b{i}", f"tel: 303-555-01{i:02d} please") for i in range(40)] + [("t", "x", "see order 303-555-0142 was sent")]
    df, parts = frames(spark, rows)
    found = {r["rec_key"] for r in pii.find_pii(df, parts).collect()}
    assert "x" not in found and {f"b{i}" for i in range(40)} <= found


def test_removed_generalised_or_kept(spark):
    rows = [("t", f"c{i}", x) for i, x in enumerate(corpus())] + [("t", k, x) for k, x, _ in UNCLEAR]
    df, parts = frames(spark, rows)
    clean = {r["rec_key"]: r["text"] for r in pii.sanitize(df, parts).collect()}
    assert clean["unlisted"] == "Contact [PERSON_NAME] for details."
    assert clean["product"] == "Hope Server handles it" and clean["none"] is None and clean["empty"] == ""
    rough = {r["rec_key"]: r["text"] for r in pii.sanitize(df, parts, threshold=1.1, general=0.5).collect()}
    assert rough["unlisted"] == "Contact O. A. for details." and rough["phone"] == "Call ###-###-#### now"
    assert len(clean) == len(rows)


def test_offsets_are_code_points(spark):
    df = spark.createDataFrame([("t", "1", "😀 write a@b.example 😀 a@b.example")], "tbl string, rec_key string, text string")
    parts = spark.createDataFrame(PARTS, "name_part string, part_kind string")
    assert pii.sanitize(df, parts).first()["text"] == "😀 write [EMAIL] 😀 [EMAIL]"
