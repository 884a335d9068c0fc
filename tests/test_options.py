import itertools
import json
import re

from pyspark.sql import functions as F

from docloom.functions import options as O


def expected(options, host_lang, host_device):
    def text(key):
        v = options.get(key)
        return v.strip() if isinstance(v, str) and v.strip() else None

    def one_of(key, allowed):
        v = (text(key) or "").lower()
        return v if v in allowed else None

    def matching(key, host, pattern):
        v = (text(key) or host or "").lower()
        return v if re.fullmatch(pattern, v) else None

    def page(key):
        v = options.get(key)
        return v if type(v) is int and v >= 0 else None

    def flag(key):
        return None if options.get(key) is None else bool(options[key])

    backend = one_of("backend", O.BACKENDS) or "pipeline"
    return (
        backend,
        None if backend.startswith("vlm") else one_of("method", O.METHODS),
        one_of("effort", O.EFFORTS) if backend.startswith("hybrid") else None,
        matching("lang", host_lang, r"[a-z][a-z_]{1,19}"),
        matching("device", host_device, r"(cpu|cuda|npu|mps|xpu)(:\d{1,2})?"),
        flag("formula"), flag("table"), page("start_page"), page("end_page"),
    )


def test_options_match_rules(spark):
    odd = [None, "", " ", "x", "EN", "e", "en_x", "cuda:12", "cuda:123", 0, 1, -1, 2.5, 0.0, True, False, [], [0], {}, {"a": 1}, "false", "High", "ocr ", 7]
    keys = ["backend", "method", "effort", "lang", "device", "formula", "table", "start_page", "end_page"]
    made = [{k: v} for k in keys for v in odd] + [{}]
    made += [dict(backend=b, method=m, effort=e) for b, m, e in itertools.product(
        ["pipeline", "VLM-engine", "hybrid-engine", "nope"], ["auto", "TXT", "bad"], ["high", "low"])]
    for lang, device in [(None, None), ("fr", "mps"), ("BAD1", "gpu")]:
        df = spark.createDataFrame([(i, json.dumps(o)) for i, o in enumerate(made)], "id int, o string").withColumn("o", F.parse_json("o"))
        cleaned = O.with_clean_options(df, "o", host_lang=lang, host_device=device)
        for r in cleaned.select("id", *[f"opt_{k}" for k in keys]).collect():
            assert tuple(r)[1:] == expected(made[r.id], lang, device), made[r.id]


def test_host_backend(spark):
    df = spark.range(1).select(F.parse_json(F.lit('{"backend": "nope"}')).alias("o"))
    for host, want in [(" Hybrid-Engine", "hybrid-engine"), ("zzz", "pipeline"), (None, "pipeline")]:
        assert O.with_clean_options(df, "o", host_backend=host).first().opt_backend == want
