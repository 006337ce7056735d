"""Secrets in text, told apart by who owns them.

Patterns give candidate spans per document. A candidate's value is then hashed and counted over
the whole corpus by distinct repositories (documents) and owners (sources): a value that several
owners hold is a widely copied example, one that a single owner holds looks like a live credential.
Kinds beyond the base ones are reported only for values that look live.

Positions are code points. They come from splitting the text at the pattern: a match starts where
the pieces and matches before it end. NULL text is empty text and has no spans; NULL owners count
as one owner; repeated rows get the same result each; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.functions.distributed import materialize
from stockledger.llm.common import row_hash


@dataclass(frozen=True)
class Kind:
    """`group` holds the secret's value, `shortest` its least length; `pattern` is a whole match."""

    name: str
    pattern: str
    group: int = 0
    shortest: int = 1


# fixed values: the base kinds in the order in which they are listed
BASE = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18),
    Kind("hex", r"[0-9a-f]+", 0, 16),
)
MORE = (
    Kind("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Kind("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Kind("prefixed", r"\b(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9-]{20,})"),
)
# runs of one class need no look at what is too short
QUICK = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}


def _parts(text: Column, kind: Kind, order: int) -> Column:
    """An array of (order, kind, nth, gap, length, value) of one kind's matches: `gap` is what lies before it since the last one."""
    pattern = QUICK.get(kind.name, kind.pattern)
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if kind.group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(kind.group))
    parts = F.zip_with(
        F.slice(pieces, 1, F.size(matches)), F.arrays_zip(matches.alias("m"), values.alias("v")),
        lambda piece, found: F.struct(F.length(piece).alias("gap"), F.length(found["m"]).alias("n"), found["v"].alias("v")),
    )
    listed = F.transform(
        parts,
        lambda part, nth: F.struct(
            F.lit(order).alias("kind_order"), F.lit(kind.name).alias("kind"), nth.alias("nth"),
            part["gap"].alias("gap"), part["n"].alias("n"), part["v"].alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), listed).otherwise(F.array().cast(PARTS))


PARTS = "array<struct<kind_order:int,kind:string,nth:int,gap:int,n:int,value:string>>"


def candidate_spans(docs: DataFrame, kinds=BASE + MORE, id_col="doc_id", text_col="text", owner_col="source") -> DataFrame:
    """`doc_id`, `row_key`, `owner`, `kind_order`, `kind`, `start`, `end`, `value_hash` of every candidate.

    A match ends where the gaps and lengths up to it do, a running sum over the matches of its text and kind.
    """
    each = [_parts(F.col(text_col), k, i) for i, k in enumerate(kinds)]
    shortest = F.create_map(*[x for k in kinds for x in (F.lit(k.name), F.lit(k.shortest))])
    upto = Window.partitionBy("row", "kind_order").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matches = docs.select(
        F.col(id_col).alias("doc_id"),
        row_hash(id_col, text_col).alias("row_key"),
        F.col(owner_col).alias("owner"),
        F.monotonically_increasing_id().alias("row"),
        F.concat(*each).alias("parts"),
    )
    matches = matches.select("doc_id", "row_key", "owner", "row", F.explode("parts").alias("s")).select("doc_id", "row_key", "owner", "row", "s.*")
    ended = matches.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto).cast("int"))
    return ended.where(F.length("value") >= shortest[F.col("kind")]).select(
        "doc_id", "row_key", "owner", "kind_order", "kind", (F.col("end") - F.col("n")).alias("start"), "end", F.xxhash64("value").alias("value_hash")
    )


def ownership(candidates: DataFrame, live_owners: int = 1) -> DataFrame:
    """Distinct repositories and owners of every candidate value, and whether it looks live.

    Each count sums what a first aggregation leaves, so that a value which half of all documents
    hold is one row per task when it is shuffled.
    """
    value = ["kind", "value_hash"]
    repositories = candidates.groupBy(*value, "owner", "row_key").agg(F.count(F.lit(1)).alias("hits"))
    by_owner = repositories.groupBy(*value, "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("hits").alias("hits")
    )
    return by_owner.groupBy(*value).agg(
        F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"), F.sum("hits").alias("hits")
    ).withColumn("live", F.col("owners") <= live_owners)


def scan_secrets(docs: DataFrame, id_col="doc_id", text_col="text", owner_col="source", live_owners: int = 1) -> DataFrame:
    """One row per document: `doc_id`, counts of the base kinds, digest, all spans, live and example values."""
    found = materialize(candidate_spans(docs, BASE + MORE, id_col, text_col, owner_col))
    judged = found.join(ownership(found, live_owners), ["kind", "value_hash"])
    base = [k.name for k in BASE]
    reported = judged.where(F.col("kind").isin(base) | F.col("live"))
    as_text = F.concat_ws(":", "kind", "start", "end")
    # a document's own spans: as many as its text holds
    repeated = reported.dropDuplicates(["row_key", "kind", "start", "end"])
    item = F.struct("start", "kind_order", as_text.alias("text"), F.col("kind").isin(base).alias("base"))

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda x: x["text"]), ",")

    per_doc = repeated.groupBy("row_key").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in base],
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_example"),
        F.array_sort(F.collect_list(item)).alias("_items"),
    )
    per_doc = per_doc.withColumn("_base", joined(F.filter("_items", lambda x: x["base"]))).withColumn("spans", joined(F.col("_items")))
    rows = docs.select(F.col(id_col).alias("doc_id"), row_hash(id_col, text_col).alias("row_key"))
    zero = F.lit(0).cast("long")
    return rows.join(per_doc, "row_key", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in base],
        F.sha2(F.coalesce("_base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("n_example", zero).alias("n_example"),
    )
