import random
import re
import time

from pyspark.sql import functions as F

from docloom.functions import budget as B
from docloom.functions import text as T

# The rules, as patterns of the language they are defined in.
FENCE = (r"^\s*```.*$", "", re.M)
IMAGE = (r"!\[([^\]]*)\]\([^)]*\)", r"\1", 0)
LINK = (r"\[([^\]]*)\]\([^)]*\)", r"\1", 0)
TAG = (r"<[^>]+>", " ", 0)
HEADING = (r"^\s{0,3}#{1,6}\s+", "", re.M)
QUOTE = (r"^\s{0,3}>\s?", "", re.M)
BULLET = (r"^\s{0,3}[-*+]\s+", "", re.M)
EMPHASIS = (r"(\*\*|__|\*|_|`)", "", 0)
RULES = [FENCE, IMAGE, LINK, TAG, HEADING, QUOTE, BULLET, EMPHASIS]


def expected_plain(text):
    for pattern, to, flags in RULES:
        text = re.sub(pattern, to, text, flags=flags)
    ends_trimmed = "\n".join(line.rstrip() for line in text.splitlines())
    return re.sub(r"\n{3,}", "\n\n", ends_trimmed).strip()


def samples(n, seed=7):
    rng = random.Random(seed)
    marks = ["#", "##", "> ", "- ", "* ", "+", "**", "__", "_", "`", "```", "```py", "[a](b)", "![a](b)",
             "[", "]", "(", ")", "!", "<b>", "</b>", "<", ">", "a < b > c", "$x_1$", "é", "€", "😀", "word", "x"]
    blanks = list(T.WHITESPACE) + ["\r\n", "\n", "\n", " ", "  ", "\n\n\n"]
    made = []
    for _ in range(n):
        pieces = [rng.choice(marks if rng.random() < 0.6 else blanks) for _ in range(rng.randint(0, 14))]
        made.append("".join(pieces))
    return made + ["#\nfoo", "a < b > c", "$x_1$", "- \n\n\nfoo", "\r\n\r\n", "", "[![a](b)](c)", "\n\n```x\n\n```"]


def test_plain_text_matches_rules(spark):
    given = list(enumerate(samples(4000)))
    df = spark.createDataFrame(given, "id int, s string")
    got = {r.id: r.p for r in T.with_plain_text(df, "s", "p").collect()}
    wrong = [(s, expected_plain(s), got[i]) for i, s in given if got[i] != expected_plain(s)]
    assert not wrong, wrong[:3]


def test_each_step_matches_its_rule(spark):
    steps = [T.strip_code_fences, T.strip_images, T.strip_links, T.strip_html_tags, T.strip_headings,
             T.strip_block_quotes, T.strip_bullets, T.strip_emphasis]
    given = list(enumerate(samples(1500, seed=11)))
    df = spark.createDataFrame(given, "id int, s string")
    rows = df.select("id", *[f(F.col("s")).alias(f"c{n}") for n, f in enumerate(steps)]).collect()
    for r in rows:
        for n, (pattern, to, flags) in enumerate(RULES):
            assert r[f"c{n}"] == re.sub(pattern, to, given[r.id][1], flags=flags), (n, given[r.id][1])


def test_strip_and_blank(spark):
    given = list(enumerate(samples(800, seed=3)))
    df = spark.createDataFrame(given, "id int, s string")
    for r in df.select("id", "s", T.py_strip(F.col("s")).alias("t"), T.is_blank(F.col("s")).alias("b")).collect():
        assert r.t == r.s.strip() and r.b == (not r.s.strip())


def test_long_runs_stay_linear(spark):
    worst = ["\n" * 200_000 + "x", " " * 200_000 + "x", "x" + " " * 200_000 + "y\n", "<" * 3_000]
    df = spark.createDataFrame(list(enumerate(worst)), "id int, s string")
    got = {r.id: r.p for r in T.with_plain_text(df, "s", "p").collect()}
    assert [got[i] for i in range(4)] == ["x", "x", worst[2].strip(), worst[3]]


def test_a_megabyte_of_openers_stays_linear(spark):
    size = 1 << 20
    worst = [mark * (size // len(mark)) for mark in ("<", "[", "![", "[a](", "![a](", "[a]", "<a ", "*_", "\r")]
    worst += [w + end for w in worst[:6] for end in (">", "]", ")", "](b)")]
    df = spark.createDataFrame(list(enumerate(worst)), "id int, s string").repartition(4)
    began = time.monotonic()
    got = {r.id: r.p for r in T.with_plain_text(df, "s", "p").collect()}
    assert time.monotonic() - began < 60
    assert got[0] == worst[0] and got[1] == worst[1] and got[8] == ""
    assert got[9] == ""  # one tag


def test_shaping_sample(spark):
    sample = (
        "# Heading\n\nSome **bold** text with a [link](http://x) and "
        "<table><tr><td>EU</td></tr></table>.\n\n- first\n- second\n"
    )
    plain = T.with_plain_text(spark.createDataFrame([(sample,)], "s string"), "s", "p").first().p
    assert "Heading" in plain and "#" not in plain and "**" not in plain
    assert "link" in plain and "EU" in plain and "<table>" not in plain


def test_clip_at_every_budget(spark):
    texts = ["aé€😀z", "x" * 100, "short", "", "😀😀", "é" * 9]
    given = [(t, n) for t in texts for n in range(0, 105)]
    df = spark.createDataFrame(given, "t string, n int")
    for r in df.select("t", "n", B.clip_bytes(F.col("t"), F.col("n")).alias("c"), B.fits(F.col("t"), F.col("n")).alias("w")).collect():
        raw = r.t.encode()
        assert r.c == raw[: r.n].decode("utf-8", "ignore")
        assert r.w == (len(raw) <= r.n)


def test_lossy_read_and_tail(spark):
    rng = random.Random(5)
    blobs = [bytes(rng.choice(b"ab \n\xc3\xa9\xe2\x82\xac\xf0\x9f\x98\x80\xff\x80") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(blobs)], "id int, b binary")
    got = df.select("id", B.lossy_text(F.col("b"), 11).alias("l"), B.log_tail(F.col("b"), 9).alias("t")).collect()
    for r in got:
        b = blobs[r.id]
        assert r.l == b[:12].decode("utf-8", "replace")
        assert r.t == (b[-9:] if len(b) > 9 else b).decode("utf-8", "replace").strip()
