"""Check records against the producers' contracts and split good from bad."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedflow.functions.contract import BLOCK_CONTRACT, TRANSACTION_CONTRACT, Contract, fits, shape, violations
from feedflow.functions.json_schema import Schema, as_contract, breaches, load, satisfies
from feedflow.functions.json_text import is_kind
from feedflow.functions.once import compute_once
from feedflow.operators.decode import parse_variant


def judge(documents: DataFrame, contract: Contract, column: str = "doc") -> DataFrame:
    """Append ``fitting``: whether the VARIANT in ``column`` keeps the contract. The fields are taken out of it once."""
    shaped = compute_once(documents, _shape=shape(F.col(column), contract))
    return compute_once(shaped, fitting=fits(F.col("_shape"), contract)).drop("_shape")


def check(documents: DataFrame, contract: Contract, column: str = "doc") -> DataFrame:
    """Append ``errors`` (array of reasons) and ``valid`` for the VARIANT in ``column``."""
    judged = judge(documents, contract, column)
    checked = compute_once(judged, errors=violations(F.col(column), contract, F.col("fitting"))).drop("fitting")
    return checked.withColumn("valid", F.size("errors") == 0)


def check_schema(documents: DataFrame, schema: Schema | str, column: str = "doc") -> DataFrame:
    """``check`` by a JSON Schema document. A schema that says what a contract can is checked as one.

    Reasons are only worked out for documents that break a rule; elements of an array share theirs.
    """
    loaded = load(schema)
    contract = as_contract(loaded)
    if isinstance(contract, dict):
        return check(documents, contract, column)
    doc = F.col(column)
    judged = compute_once(documents, _kept=F.coalesce(satisfies(doc, loaded), F.lit(False)))
    errors = (
        F.when(doc.isNull(), F.array(F.lit("malformed JSON")))
        .when(F.col("_kept"), F.array().cast("array<string>"))
        .otherwise(F.array_distinct(F.array_compact(breaches(doc, loaded))))
    )
    checked = compute_once(judged, errors=errors)
    return checked.withColumn("valid", F.col("_kept") & doc.isNotNull()).drop("_kept")


def conforming_transactions(texts: DataFrame) -> DataFrame:
    """The ``json_data`` that keeps the transaction contract; no reasons are worked out for the rest."""
    return judge(parse_variant(texts), TRANSACTION_CONTRACT).filter("fitting").drop("fitting", "doc")


def check_transactions(texts: DataFrame) -> DataFrame:
    """``json_data`` against the transaction contract."""
    return check(parse_variant(texts), TRANSACTION_CONTRACT)


def check_blocks(texts: DataFrame) -> DataFrame:
    """``json_data`` against the block contract, which holds for the object under the key ``block``.

    ``block`` is that object as VARIANT. Messages without one, or with an empty or null one, are invalid.
    """
    found = F.try_variant_get("doc", "$.block", "variant")
    blocks = compute_once(parse_variant(texts), block=found)
    checked = compute_once(blocks, _found=violations(F.col("block"), BLOCK_CONTRACT))
    empty = F.col("block").isNull() | F.is_variant_null("block") | (F.schema_of_variant("block") == "OBJECT<>")
    errors = (
        F.when(F.col("doc").isNull(), F.array(F.lit("malformed JSON")))
        .when(~is_kind(F.col("doc"), "$", "object"), F.array(F.lit("root: not object")))
        .when(F.coalesce(empty, F.lit(True)), F.array(F.lit("block: missing or empty")))
        .when(~is_kind(F.col("block"), "$", "object"), F.array(F.lit("block: not object")))
        .otherwise(F.col("_found"))
    )
    return compute_once(checked, errors=errors).drop("_found").withColumn("valid", F.size("errors") == 0)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter("valid")


def rejected(checked: DataFrame) -> DataFrame:
    """The reject table: lineage, the original text and all reasons in one string."""
    lineage = [name for name in ("topic", "partition", "offset") if name in checked.columns]
    return checked.filter("NOT valid").select(
        *lineage, F.col("json_data").alias("value"), F.array_join("errors", "; ").alias("reason")
    )


def well_formed(table: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` holds one well-formed JSON value."""
    return parse_variant(table, column, "_doc").filter(F.col("_doc").isNotNull()).drop("_doc")
