"""Typed option columns from a free-form VARIANT.

Unknown keys and values are ignored, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import py_strip

# What each option accepts.
BACKENDS = (
    "pipeline",
    "vlm-engine",
    "vlm-http-client",
    "hybrid-engine",
    "hybrid-http-client",
    "vlm-transformers",
    "vlm-sglang-engine",
    "vlm-sglang-client",
    "vlm-vllm-engine",
    "vlm-vllm-async-engine",
)
DEFAULT_BACKEND = "pipeline"
METHODS = ("auto", "txt", "ocr")
EFFORTS = ("medium", "high")
LANG_PATTERN = r"^[a-z][a-z_]{1,19}\z"
DEVICE_PATTERN = r"^(cpu|cuda|npu|mps|xpu)(:[0-9]{1,2})?\z"


TEXT_KEYS = ("backend", "method", "effort", "lang", "device")
FLAG_KEYS = ("formula", "table")
PAGE_KEYS = ("start_page", "end_page")
OPTION_NAMES = (*TEXT_KEYS, *FLAG_KEYS, *PAGE_KEYS)


def _known_backend(name: str | None) -> str:
    name = (name or "").strip().lower()
    return name if name in BACKENDS else DEFAULT_BACKEND


def _truth(field: Column, kind: Column) -> Column:
    """Truth of any non-null value: zero and empty are false, all else true."""
    shown = F.try_variant_get(field, "$", "string")
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(None).cast("boolean"))
        .when(kind == "BOOLEAN", F.try_variant_get(field, "$", "boolean"))
        .when(kind == "STRING", shown != "")
        .when(F.startswith(kind, F.lit("ARRAY")), shown != "[]")
        .when(F.startswith(kind, F.lit("OBJECT")), shown != "{}")
        .otherwise(F.try_variant_get(field, "$", "double") != 0)
    )


def with_clean_options(
    df: DataFrame,
    options: str,
    host_backend: str | None = None,
    host_lang: str | None = None,
    host_device: str | None = None,
) -> DataFrame:
    """Adds one typed ``opt_`` column per option; null means it is not passed on.

    Staged, so that each field is looked up and typed once: first the fields, then
    their types, then cleaned texts, then the rules that look at several of them.
    """
    keys = OPTION_NAMES
    looked_up = df.withColumns(
        {f"_{k}": F.try_variant_get(F.col(options), f"$.{k}", "variant") for k in keys}
    )
    typed = looked_up.withColumns({f"_{k}_type": F.schema_of_variant(f"_{k}") for k in keys})
    # A text option is a string that is not blank; anything else counts as absent.
    trimmed = typed.withColumns(
        {
            f"_{k}": F.when(
                F.col(f"_{k}_type") == "STRING",
                F.lower(py_strip(F.try_variant_get(F.col(f"_{k}"), "$", "string"))),
            )
            for k in TEXT_KEYS
        }
    )
    # A request value hides the host default even when it turns out invalid.
    hosts = {"lang": host_lang, "device": host_device}
    texts = trimmed.withColumns(
        {
            f"_{k}": F.coalesce(
                F.when(F.col(f"_{k}") != "", F.col(f"_{k}")),
                F.lit((hosts.get(k) or "").strip().lower() or None).cast("string"),
            )
            for k in TEXT_KEYS
        }
    )
    asked = {k: F.col(f"_{k}") for k in TEXT_KEYS}
    fallback = F.lit(_known_backend(host_backend))
    resolved = texts.withColumn(
        "opt_backend", F.when(asked["backend"].isin(*BACKENDS), asked["backend"]).otherwise(fallback)
    )
    backend = F.col("opt_backend")

    def page(key: str) -> Column:
        # Only integers of at most 64 bits, from 0 up.
        number = F.when(
            F.col(f"_{key}_type") == "BIGINT", F.try_variant_get(F.col(f"_{key}"), "$", "bigint")
        )
        return F.when(number >= 0, number)

    cleaned = resolved.withColumns(
        {
            "opt_method": F.when(
                asked["method"].isin(*METHODS) & ~F.startswith(backend, F.lit("vlm")),
                asked["method"],
            ),
            "opt_effort": F.when(
                asked["effort"].isin(*EFFORTS) & F.startswith(backend, F.lit("hybrid")),
                asked["effort"],
            ),
            "opt_lang": F.when(asked["lang"].rlike(LANG_PATTERN), asked["lang"]),
            "opt_device": F.when(asked["device"].rlike(DEVICE_PATTERN), asked["device"]),
            **{f"opt_{k}": _truth(F.col(f"_{k}"), F.col(f"_{k}_type")) for k in FLAG_KEYS},
            **{f"opt_{k}": page(k) for k in PAGE_KEYS},
        }
    )
    return cleaned.drop(*[f"_{k}" for k in keys], *[f"_{k}_type" for k in keys])


def options_json() -> Column:
    """The cleaned options of a row as JSON, without those that are not passed on."""
    return F.to_json(F.struct(*[F.col(f"opt_{k}").alias(k) for k in OPTION_NAMES]))
