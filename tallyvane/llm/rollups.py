"""Token totals by source, language and tokenizer version, kept up by signed changes.

A batch holds inserts, deletes and revisions of documents' counts. Each becomes signed amounts: +1 document and +n tokens,
-1 and -n, or for a revision -1 and -old under the old key and +1 and +new under the new one. Committing a batch adds its
sums by key to the running totals: the new totals are written beside the old ones, then one log entry (number, batch
id, folder of the totals) is written under another name and renamed to its number, and that is the commit: a rename
that would replace an entry fails, so of two writers at once one does it again. What died before has changed nothing and
is done again; a batch whose id is in the log is left out, so a retried or replayed batch never counts twice. Readers
follow the newest entry and never see half a batch. Every FOLD entries the ids so far are written as a table and the
entries behind it go, so a commit costs its batch, the keys there are and a bounded number of entries.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvane.llm.common import on_disk, removed, small_batches

KEYS = ("source", "lang", "tokenizer")
UNKNOWN = "unknown"
TOTALS = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
#: Entries of the log between two tables of all ids.
FOLD = 64


@cache
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(path: str, name: bool = True):
    """A column function: the number of a text's tokens under a ranked byte-pair vocabulary (a public one's name, or a path). Null texts have none."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoding(public_tokenizers.path(path) if name else path).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return run


def token_counts(docs: DataFrame, vocabularies: Mapping[str, Column], text_col: str = "text") -> DataFrame:
    """docs with a count of tokens for each vocabulary, as column of its name without ending; null where its condition doesn't hold.

    Texts are read whole, in one pass, and aren't kept. Rows that repeat are each counted; columns of these names give way.
    """
    small_batches(docs.sparkSession)
    names = {v: v.rsplit(".", 1)[0] for v in vocabularies}
    texts = docs.withColumns({f"_{n}": F.when(c, F.col(text_col)) for (v, c), n in zip(vocabularies.items(), names.values(), strict=True)})
    counted = texts.withColumns({n: count_tokens(v)(F.col(f"_{n}")) for v, n in names.items()})
    kept = counted.withColumns({n: F.when(c, F.col(n)) for (v, c), n in zip(vocabularies.items(), names.values(), strict=True)})
    return kept.drop(*(f"_{n}" for n in names.values()), text_col)


def _side(prefix: str, sign: int) -> Column:
    return F.struct(
        *(F.coalesce(F.col(f"{prefix}_{k}"), F.lit(UNKNOWN)).alias(k) for k in KEYS),
        F.lit(sign).cast("long").alias("docs"),
        (sign * F.coalesce(F.col(f"{prefix}_tokens"), F.lit(0))).cast("long").alias("tokens"),
    )


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows (source, lang, tokenizer, docs, tokens) of changes.

    changes has op (`insert`, `delete` or `revise`), and old_ and new_ source, lang, tokenizer and tokens: an insert's new
    ones, a delete's old ones, and both of a revision. Null keys count under `unknown`, null tokens as 0; rows of
    another op, or none, say nothing. Repeated rows count each: what is a repeat is for the batch id to tell. An empty
    table gives no rows; other columns aren't read.
    """
    sides = F.when(F.col("op") == "insert", F.array(_side("new", 1))).when(F.col("op") == "delete", F.array(_side("old", -1))).when(F.col("op") == "revise", F.array(_side("old", -1), _side("new", 1)))
    return changes.select(F.explode(sides).alias("s")).select("s.*")


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")


@dataclass(frozen=True)
class Entry:
    """A commit: its number, the batch, the folder of the totals after it, and a table of all ids up to it if one was written."""

    number: int
    batch_id: str
    totals: str
    folded: str | None = None


def _entries(spark: SparkSession, ledger: str) -> list[Entry]:
    """By number. Names that aren't a number's, of writers that died or are still at it, are no entries."""
    files, folder = on_disk(spark, f"{ledger}/log")
    if not files.exists(folder):
        return []
    names = (s.getPath() for s in files.listStatus(folder))
    return sorted((Entry(**json.loads(_text(spark, files, path))) for path in names if re.fullmatch(r"[0-9]{12}\.json", path.getName())), key=lambda e: e.number)


def _text(spark: SparkSession, files, path) -> str:
    source = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def _record(spark: SparkSession, ledger: str, entry: Entry) -> None:
    """The commit: written whole under a name that says nothing, then renamed without replacing."""
    jvm = spark.sparkContext._jvm
    files, whole = on_disk(spark, f"{ledger}/log/.{uuid.uuid4().hex}")
    out = files.create(whole, False)
    out.write(bytearray(json.dumps(vars(entry)).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    _, final = on_disk(spark, f"{ledger}/log/{entry.number:012d}.json")
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(whole, final, options)
    except Exception as e:
        files.delete(whole, False)
        if "FileAlreadyExists" in str(e):
            raise Overtaken(f"entry {entry.number} was written by another commit") from e
        raise


class Overtaken(RuntimeError):
    """Another writer took the entry that a commit was about to write; nothing has changed, and it may be done again."""


def _known(spark: SparkSession, entries: list[Entry]) -> tuple[set[str], DataFrame | None]:
    """Ids of committed batches: those of the entries since the last table of ids, and that table."""
    folded = next((e for e in reversed(entries) if e.folded), None)
    since = {e.batch_id for e in entries if folded is None or e.number > folded.number}
    return since, spark.read.schema("batch_id string").parquet(folded.folded) if folded else None


def commit(changes: DataFrame, ledger: str, batch_id: str, fold: int = FOLD) -> bool:
    """Add the batch to the ledger's totals; False, and nothing done, if it was committed before. An empty batch only leaves its id.

    Raises Overtaken where another writer committed meanwhile.
    """
    spark = changes.sparkSession
    entries = _entries(spark, ledger)
    since, before = _known(spark, entries)
    if batch_id in since or (before is not None and not before.where(F.col("batch_id") == batch_id).isEmpty()):
        return False
    number, folder = (entries[-1].number, entries[-1].totals) if entries else (0, None)
    delta = summed(signed(changes))
    new = f"{ledger}/totals/{number + 1:012d}-{uuid.uuid4().hex}"
    (delta if folder is None else summed(spark.read.schema(TOTALS).parquet(folder).unionByName(delta))).write.parquet(new)
    ids = None
    if (number + 1) % fold == 0:
        ids = f"{ledger}/ids/{number + 1:012d}-{uuid.uuid4().hex}"
        fresh = spark.createDataFrame([(b,) for b in sorted(since | {batch_id})], "batch_id string").coalesce(1)
        (fresh if before is None else before.unionByName(fresh)).write.parquet(ids)
    _record(spark, ledger, Entry(number + 1, batch_id, new, ids))
    # The totals before these stay for readers that began with them; those before go, and entries that a table of ids covers.
    for old in entries[:-1]:
        if old.number == number - 1:
            removed(spark, old.totals)
        if ids:
            removed(spark, f"{ledger}/log/{old.number:012d}.json")
            if old.folded and entries[-1].folded != old.folded:
                removed(spark, old.folded)
    return True


def totals(spark: SparkSession, ledger: str) -> DataFrame:
    """The totals after the newest commit, without keys of which nothing is left; no rows where nothing was committed yet."""
    entries = _entries(spark, ledger)
    return spark.read.schema(TOTALS).parquet(entries[-1].totals) if entries else spark.createDataFrame([], TOTALS)
