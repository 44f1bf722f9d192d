"""Secret scans with an incremental blob ledger, in SQL functions only.

Every version of a text is named by the hash of its content. The ledger is a
table of (blob, rules, findings); a scan looks only at blobs whose pair with the
present rule version is not in it, and the findings are joined back to every
path that holds the blob. Copies are therefore scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordwise.llm import spans as S
from ordwise.llm.common import cut, spread_lookup, text_of

BASE_KINDS = ["assign", "access", "hex"]
ADDED_KINDS = ["private_key", "bearer", "provider"]
KINDS = BASE_KINDS + ADDED_KINDS
#: Goes up whenever a pattern or check below changes; ledger rows of other versions are ignored.
RULES = "1"

_ASSIGN_HEAD = r'(?i:password|passwd|secret|token|api_?key)["\x27]?\x20*[:=]\x20*["\x27]?'
PATTERNS = {
    "assign": _ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+",
    # maximal runs: at most one match can start in a run, so the lengths can be in the pattern
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "private_key": r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----",
    "bearer": r"(?i:\bbearer)\x20+[A-Za-z0-9._~+/=-]{20,}",
    "provider": r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})",
}


#: Group 2 of an assignment has 12 characters or more; the other patterns need no check.
VALID = {"assign": f"length(regexp_extract(m.value, {S.literal('^' + _ASSIGN_HEAD + '([A-Za-z0-9+/_.=-]+)')}, 1)) >= 12"}
_PRESENT = {"access": "contains(text, 'AKIA')", "private_key": "contains(text, 'PRIVATE KEY')"}


def blob_of(text: Column) -> Column:
    """Content address: SHA-256 of the UTF-8 bytes."""
    return F.sha2(text, 256)


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """(blob, text) -> (blob, rules, findings) by scanning every given text whole."""
    df = blobs.select("blob", *[F.expr(S.found("text", PATTERNS[k], _PRESENT.get(k, "true"))).alias(f"__m_{k}")
                                for k in KINDS])
    every = "concat(" + ", ".join(S.as_spans(f"__m_{k}", k, VALID.get(k, "true")) for k in KINDS) + ")"
    return df.select("blob", F.lit(RULES).alias("rules"), F.expr(S.by_start(every, KINDS)).alias("findings"))


LEDGER = "blob string, rules string, findings array<struct<kind:string,start:bigint,end:bigint>>"


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger table at ``path``; empty where there is none yet."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_ledger(spark)


def unseen(versions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """(blob, text) of each distinct blob of ``versions`` (blob, text) without a ledger row.

    Copies are combined before the shuffle; the ledger then meets one row per blob.
    """
    new = versions.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        return new
    return new.join(ledger.filter(F.col("rules") == RULES).select("blob").distinct(), "blob", "left_anti")


def _paths(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_of().alias("text")).withColumn("blob", blob_of(F.col("text")))


def _joined_back(paths: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, blob, findings of every path. One blob may fill a third of all paths: its rows are spread."""
    hits = known.filter(F.size("findings") > 0).select("blob", "findings")      # others need no partner
    rows = paths.select("doc_id", "blob")
    # the paths of one blob differ in doc_id, or are repeated rows
    found = spread_lookup(rows, "blob", hits, F.xxhash64("doc_id"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return found.select("doc_id", "blob", F.coalesce("findings", none).alias("findings"))


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings per row of ``docs``, new ledger rows).

    The first frame has doc_id, blob and findings (kind, start, end by start, then
    kind) for every row; a null text counts as empty, a null doc_id and repeated
    rows are kept, an empty table gives no rows. The second holds the blobs that
    were scanned now; append it to the ledger to skip them next time (as
    ``scan_into_ledger`` does).
    """
    paths = _paths(docs)
    new = cut(scan_blobs(unseen(paths.select("blob", "text"), ledger)))
    known = new
    if ledger is not None:
        known = new.unionByName(_of_rules(ledger).select(*new.columns))
    return _joined_back(paths, known), new


def _of_rules(ledger: DataFrame) -> DataFrame:
    """One row per blob of the present rules (a writer that died may have appended twice)."""
    return ledger.filter(F.col("rules") == RULES).dropDuplicates(["blob"])


def scan_into_ledger(docs: DataFrame, path: str) -> DataFrame:
    """Findings per row of ``docs`` (as ``scan_secrets``) through the ledger table at ``path``.

    Blobs that the ledger lacks under the present rules are scanned and appended to it (one
    writer at a time); the findings of all paths are then read from the ledger.
    Run again with more versions, it scans only what is new.
    """
    spark = docs.sparkSession
    paths = _paths(docs)
    scan_blobs(unseen(paths.select("blob", "text"), read_ledger(spark, path))).write.mode("append").parquet(path)
    return _joined_back(paths, _of_rules(read_ledger(spark, path)))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_secrets``' first frame."""
    names = ", ".join(f"'{k}'" for k in BASE_KINDS)
    df = found.select("*", F.expr(f"filter(findings, s -> s.kind IN ({names}))").alias("__base"))
    return df.select(
        "doc_id", *[F.expr(f"cast(size(filter(findings, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}")
                    for k in BASE_KINDS],
        F.expr(f"sha2({S.joined('__base')}, 256)").alias("base_sha256"),
        F.expr(S.joined("findings")).alias("spans"), "blob")
