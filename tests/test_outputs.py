from docloom.limits import Limits
from docloom.operators import outputs as G
from docloom.operators import results as R


def test_pick_markdown(spark):
    rows = [
        (1, "o/b.md", 9, "doc"), (1, "o/Doc.md", 1, "doc"), (1, "o/doc.txt", 99, "doc"),
        (2, "o/b.md", 5, "doc"), (2, "o/a.md", 5, "doc"), (2, "o/c.md", 4, "doc"),
        (3, "o/x.json", 5, "doc"),
    ]
    df = spark.createDataFrame(rows, "parse_id int, file string, size bigint, wanted string")
    picked = G.pick_markdown(df)
    assert sorted((r.parse_id, r.file, r.size) for r in picked.collect()) == [(1, "o/Doc.md", 1), (2, "o/a.md", 5)]
    parses = spark.createDataFrame([(2, "b.pdf", b"x"), (3, "d/c.pdf", "tail é".encode()), (4, "e.pdf", b" ")], "parse_id int, filename string, log binary")
    missing = sorted((r.parse_id, r.error_code, r.error) for r in G.missing_output(parses, picked).collect())
    assert missing == [
        (3, "parse_failed", "the parser wrote no markdown for `c.pdf`: tail é"),
        (4, "parse_failed", "the parser wrote no markdown for `e.pdf`"),
    ]


def test_page_count_and_window(spark):
    bodies = {
        (1, "a_content_list.json"): '[{"page_idx": 0}, {"page_idx": 1}]',
        (2, "a_content_list.json"): '[{"page_idx": "7"}, {"page_idx": 2.5}, 5, null]',
        (2, "b_content_list.json"): '[{"page_idx": true}]',
        (3, "a_content_list.json"): '{"page_idx": 3}',
        (4, "a_content_list.json"): "not json",
        (4, "b_content_list.json"): '[{"page_idx": 8}, {"page_idx": 3}]',
        (4, "c_content_list.json"): '[{"page_idx": 80}]',
        (5, "other.json"): '[{"page_idx": 3}]',
        (6, "a_content_list.json"): '[{"page_idx": -4}]',
        (8, "a_content_list.json"): '[{"page_idx": 0, "score": NaN}, {"page_idx": 4, "x": [-Infinity,NaN]}]',
        (9, "a_content_list.json"): '[{"page_idx": 1, "page_idx": 5}]',
        (7, "a_content_list.json"): '[{"page_idx": 1, "pad": "' + "x" * 200 + '"}]',
    }
    rows = [(*k, v, len(v)) for k, v in bodies.items()]
    df = spark.createDataFrame(rows, "parse_id int, file string, json string, size bigint")
    got = {r.parse_id: r.page_count for r in G.page_count(df, max_bytes=200).collect()}
    assert got == {1: 2, 2: 2, 3: None, 4: 9, 6: -3, 8: 5, 9: 6}
    kept = sorted((r.parse_id, r.item_no, r.page_idx) for r in G.page_window(df, 1, 8).collect())
    assert kept == [(1, 1, 1), (2, 0, 1), (4, 0, 8), (4, 1, 3), (5, 0, 3), (7, 0, 1), (8, 1, 4), (9, 0, 5)]
    assert G.page_window(df, None, 0).count() == 3


def shaped(spark, markdown, budget, min_text):
    row = ("a.pdf", markdown, ["w"], ["a.pdf"], 2, False, "pipeline", None, None, [])
    df = spark.createDataFrame(
        [row],
        "filename string, markdown string, warnings array<string>, sources array<string>, page_count bigint, "
        "over_budget boolean, parse_backend string, error_code string, error string, missing_dependencies array<string>",
    )
    return R.shape_results(df, budget, min_text, host_warnings=["host"]).first()


def test_round_trip(spark):
    r = shaped(spark, "# Title\n\nBody with $E = mc^2$.\n", 1 << 20, 1000)
    assert r.error_code is None and not r.result.truncated
    assert r.result.text == "Title\n\nBody with $E = mc^2$." and r.result.warnings == ["host", "w"]
    assert r.result.metadata.page_count == 2 and r.result.metadata.parse_backend == "pipeline"


def test_budget_is_shared(spark):
    r = shaped(spark, "# Title\n\n" + "lorem ipsum " * 33_000, 100_000, 1000)
    md, text = len(r.result.markdown.encode()), len(r.result.text.encode())
    assert md <= 100_000 and md + text <= 100_000
    assert r.result.truncated and "plain text is cut" in r.result.warnings[-1]


def test_text_takes_what_is_left(spark):
    body = "é" * 400
    r = shaped(spark, body, 1000, 100)
    assert not r.result.truncated and r.result.markdown == body
    assert r.result.text == "é" * 100 and "plain text is cut" in r.result.warnings[-1]
    assert shaped(spark, body, 1000, 201).result.text == ""


def test_blank_is_a_failure(spark):
    r = shaped(spark, " \n ", 1000, 100)
    assert r.result is None and r.error_code == "parse_failed" and "`a.pdf`" in r.error


def test_mirror_warning_names_the_budget():
    assert "8 MiB" in R.mirror_warning(8 << 20) and "1000 bytes" in R.mirror_warning(1000)


def test_limits():
    got = Limits.from_overrides({"max_jobs": "1", "timeout_secs": " 900 ", "max_archive_members": "junk", "x": 1})
    assert (got.max_jobs, got.timeout_secs, got.max_archive_members) == (4, 900, 512)
    assert Limits.from_overrides({"max_output_bytes": ""}).max_output_bytes == 8 << 20


def test_collect_output_trees(spark, tmp_path):
    from docloom.plans.collect_outputs import collect_outputs

    def put(path, data):
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)

    put("p1/doc/auto/DOC.md", b"# Hi \xff")
    put("p1/doc/auto/bigger.md", b"#" * 50)
    put("p1/doc/auto/doc_content_list.json", b'[{"page_idx": 0}, {"page_idx": 1}]')
    put("p2/a_content_list.json", b'[{"page_idx": 4}]')
    put("p3/x.md", b"other name")
    put("p3/x_content_list.json", b'\xff[{"page_idx": 4}]')
    parses = spark.createDataFrame([(f"p{i}", "doc.pdf", b"boom") for i in (1, 2, 3, 4)], "parse_id string, filename string, log binary")
    got = {r.parse_id: r for r in collect_outputs(spark, str(tmp_path), parses).collect()}
    assert (got["p1"].markdown, got["p1"].page_count, got["p1"].error_code) == ("# Hi �", 2, None)
    assert got["p2"].error == got["p4"].error == "the parser wrote no markdown for `doc.pdf`: boom"
    assert got["p2"].page_count is None and got["p3"].markdown == "other name" and got["p3"].page_count is None


def test_collect_hidden_outputs(spark, tmp_path):
    from docloom.plans.collect_outputs import collect_outputs

    def put(path, data):
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)

    for name in ("_b", "p1/.c/d/_e", "p2"):
        put(f"{name}/sub/doc.md", name.encode())
        put(f"{name}/sub/doc_content_list.json", b'[{"page_idx": 2}]')
    put("p2/._doc.md", b"not chosen")
    put("p3/_doc.md", b"alone")
    put("p4/doc.md", b"kept")
    put("p4/_content_list.json", b'[{"page_idx": 2}]')
    parses = spark.createDataFrame([(p, "doc.pdf", b"") for p in ("_b", "p1", "p2", "p3", "p4", "p5")], "parse_id string, filename string, log binary")
    got = {r.parse_id: tuple(r)[2:] for r in collect_outputs(spark, str(tmp_path), parses, in_tasks=False).collect()}
    unread = "a file name that starts with `_` or `.` is not read: `%s`"
    assert got == {
        "_b": ("_b", 3, None, None),
        "p1": ("p1/.c/d/_e", 3, None, None),
        "p2": ("p2", 3, None, None),
        "p3": (None, None, "input_rejected", unread % "p3/_doc.md"),
        "p4": ("kept", None, "input_rejected", unread % "p4/_content_list.json"),
        "p5": (None, None, "parse_failed", "the parser wrote no markdown for `doc.pdf`"),
    }
    # Tasks read names of every kind.
    got = {r.parse_id: tuple(r)[2:] for r in collect_outputs(spark, str(tmp_path), parses).collect()}
    assert got == {
        "_b": ("_b", 3, None, None),
        "p1": ("p1/.c/d/_e", 3, None, None),
        "p2": ("p2", 3, None, None),
        "p3": ("alone", None, None, None),
        "p4": ("kept", 3, None, None),
        "p5": (None, None, "parse_failed", "the parser wrote no markdown for `doc.pdf`"),
    }
