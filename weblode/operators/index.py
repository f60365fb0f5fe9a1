"""The index: parquet files in hash buckets of the document id, changed by commits.

A commit writes its buckets into a folder of its own and then one row into the index's log: for each bucket it touched
the folders that hold it now. After some commits the state is written out, one row per bucket, and a new log
begins, so reading costs the buckets and a few commits, whatever the history. A commit that fails halfway
leaves nothing but an unused folder. One job writes into an index at a time.

Beside the documents stands a table of their identity features in hash buckets of these, written by the same commit: a batch
looks its records up in the buckets it touches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.operators.records import last_of_each, not_indexed, scalar
from weblode.session import stored, work_path

BUCKET = "bucket"
LOG = "version long, batch string, schema string, identity array<string>, count int, buckets map<string,array<string>>, keys map<string,array<string>>"
# Tells which records of a batch take the place of a document; it is not indexed.
REPLACES = "_replaces"
STATE = "kind string, name string, folders array<string>, number long"

# A bucket that consists of more appended parts is put together when it is next written.
MOST_PARTS = 16
# So many commits are logged before the state is written out.
MOST_COMMITS = 16


@dataclass
class State:
    """What the newest commit says; ``epoch`` numbers the written states, ``logged`` counts the commits since."""

    version: int = 0
    schema: T.StructType | None = None
    count: int = 0
    # The features by which every document stands in the table of identities.
    identity: tuple[str, ...] = ()
    buckets: dict[int, list[str]] = field(default_factory=dict)
    keys: dict[int, list[str]] = field(default_factory=dict)
    # The highest committed batch of each source.
    batches: dict[str, int] = field(default_factory=dict)
    epoch: int = 0
    logged: int = 0

    def apply(self, row) -> None:
        """One row of the log."""
        self.version, self.count, self.identity = row["version"], row["count"], tuple(row["identity"] or ())
        self.schema = T.StructType.fromJson(json.loads(row["schema"]))
        self.buckets |= {int(b): f for b, f in row["buckets"].items()}
        self.keys |= {int(b): f for b, f in row["keys"].items()}
        if row["batch"]:
            source, number = batch_number(row["batch"])
            self.batches[source] = number
        self.logged += 1

    def rows(self) -> list[tuple]:
        heads = [("head", self.schema.json(), list(self.identity), self.version), ("count", None, None, self.count)]
        parts = [(kind, str(b), f, None) for kind, held in (("bucket", self.buckets), ("key", self.keys)) for b, f in held.items()]
        return heads + parts + [("batch", source, None, n) for source, n in self.batches.items()]

    @staticmethod
    def of(rows, epoch: int) -> State:
        state = State(epoch=epoch)
        for row in rows:
            match row["kind"]:
                case "head":
                    state.schema, state.version, state.identity = T.StructType.fromJson(json.loads(row["name"])), row["number"], tuple(row["folders"])
                case "count":
                    state.count = row["number"]
                case "batch":
                    state.batches[row["name"]] = row["number"]
                case kind:
                    (state.buckets if kind == "bucket" else state.keys)[int(row["name"])] = row["folders"]
        return state


def batch_number(batch: str) -> tuple[str, int]:
    """The source of a batch and its number there: ``name-7`` is number 7 of ``name``."""
    source, _, number = batch.rpartition("-")
    return (source, int(number)) if source and number.isdigit() else (batch, 0)


def tolerant(records: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to their mapped types; a value that does not fit becomes NULL, its row stays."""
    out = []
    for name in records.columns:
        column = F.col(name)
        if name in types:
            try:
                cast = column.try_cast(types[name]).alias(name)
                records.select(cast)
            except AnalysisException:
                # No value of the one type is one of the other.
                cast = F.lit(None).cast(types[name]).alias(name)
            column = cast
        out.append(column)
    return records.select(*out)


def upserted(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table with changed rows replaced and new ones added; ``changes`` has one row per key."""
    kept = current.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def newest_epoch(spark: SparkSession, path: str) -> int:
    """The last state that was written out whole, 0 before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [int(s.getPath().getName()) for s in files.listStatus(folder)] if files.exists(folder) else []
    for epoch in sorted(names, reverse=True):
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state/{epoch}/_SUCCESS")):
            return epoch
    return 0


def read_state(spark: SparkSession, path: str) -> State:
    epoch = newest_epoch(spark, path)
    # One row per bucket, and the commits since.
    state = State.of(spark.read.schema(STATE).json(f"{path}/state/{epoch}").collect(), epoch) if epoch else State()
    try:
        for row in spark.read.schema(LOG).json(f"{path}/log/{epoch}").orderBy("version").collect():
            state.apply(row)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return state


def read_buckets(spark: SparkSession, path: str, state: State, wanted=None) -> DataFrame:
    """The documents of some buckets, or of all; columns that older parts lack are NULL."""
    parts = [f"{path}/data/{p}/{BUCKET}={b}" for b, folders in state.buckets.items() if wanted is None or b in wanted for p in folders]
    if not parts:
        return spark.createDataFrame([], state.schema)
    return spark.read.schema(state.schema).parquet(*parts)


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The indexed documents, None if there are none yet."""
    state = read_state(spark, path)
    return None if state.schema is None else read_buckets(spark, path, state)


def log_row(version: int, batch: str | None, schema: T.StructType, identity: Sequence[str], count: int, buckets: dict, keys: dict) -> tuple:
    return version, batch, schema.json(), list(identity), count, {str(b): f for b, f in buckets.items()}, {str(b): f for b, f in keys.items()}


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64((F.col(key) if isinstance(key, str) else key).cast("string")), F.lit(buckets)).cast("int")


def numbers_in(frame: DataFrame, column: str) -> set[int]:
    """The distinct values of a column of bucket numbers: at most one small integer per bucket."""
    return {r[0] for r in frame.select(column).distinct().collect()}


def identity_fields(identity: Sequence[str], schema: T.StructType) -> list[T.StructField]:
    """The identity features as they are compared: an array's element, in the type the index has."""
    kinds = [schema[c].dataType for c in identity]
    return [T.StructField(f"feature_{i}", k.elementType if isinstance(k, T.ArrayType) else k) for i, k in enumerate(kinds)]


def identity_of(records: DataFrame, identity: Sequence[str], schema: T.StructType) -> list[Column]:
    fields = identity_fields(identity, schema)
    return [scalar(records, c).try_cast(f.dataType).alias(f.name) for c, f in zip(identity, fields, strict=True)]


def read_keys(spark: SparkSession, path: str, state: State, key: str, wanted: set[int]) -> DataFrame:
    """(identity features, document id) of some buckets of the table of identities."""
    schema = T.StructType([*identity_fields(state.identity, state.schema), T.StructField("document", state.schema[key].dataType)])
    parts = [f"{path}/keys/{p}/{BUCKET}={b}" for b in sorted(wanted & state.keys.keys()) for p in state.keys[b]]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def known_identities(spark: SparkSession, path: str, state: State, asked: DataFrame, key: str) -> DataFrame:
    """The identity features of documents that records of ``asked`` may equal.

    ``asked`` has the features as ``identity_of`` names them. Where the document id is the identity, its buckets are read, and of these
    one column. Else the table of identities names the documents, and these are looked at: what it says of a document that was
    replaced since does not count.
    """
    names = [f.name for f in identity_fields(state.identity, state.schema)]
    if state.identity == (key,):
        touched = numbers_in(asked.select(bucket_of(F.col(names[0]), state.count).alias(BUCKET)), BUCKET)
        documents = read_buckets(spark, path, state, touched)
        return documents.select(*identity_of(documents, state.identity, state.schema))
    touched = numbers_in(asked.select(F.pmod(F.xxhash64(*names), F.lit(state.count)).cast("int").alias(BUCKET)), BUCKET)
    named = read_keys(spark, path, state, key, touched).join(asked.select(*names).distinct(), names, "left_semi").select("document").distinct()
    named = stored(named.withColumn(BUCKET, bucket_of("document", state.count)), work_path(spark, "named"))
    documents = read_buckets(spark, path, state, numbers_in(named, BUCKET))
    documents = documents.select(key, *identity_of(documents, state.identity, state.schema))
    return documents.join(named, documents[key] == named["document"], "left_semi").select(*names)


def not_in_index(path: str, records: DataFrame, identity: Sequence[str], key: str) -> DataFrame:
    """Records that no document of the index equals on all identity features; only buckets they fall into are read.

    An index that was not told of these features by every ``upsert`` is read whole.
    """
    spark = records.sparkSession
    state = read_state(spark, path)
    if state.schema is None:
        return records
    if state.identity != tuple(identity):
        return not_indexed(records, read_buckets(spark, path, state), identity)
    # The records are asked for their buckets first; what led to them is not computed again.
    records = stored(records, work_path(spark, "records"))
    features = identity_of(records, identity, state.schema)
    asked = records.select(*features).where(reduce(lambda a, b: a & b, [F.col(f.name).isNotNull() for f in identity_fields(identity, state.schema)]))
    known = known_identities(spark, path, state, asked, key)
    same = [f == known[n] for f, n in zip(features, known.columns, strict=True)]
    return records.join(known, same, "left_anti")


def new_or_earlier(path: str, records: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """Records whose id the index does not hold, and those that arrived before the document under their id; ``REPLACES`` marks the latter.

    ``records`` has one row per id; the index holds the arrival columns. Only buckets the records fall into are read.
    """
    spark = records.sparkSession
    state = read_state(spark, path)
    if state.schema is None:
        return records.withColumn(REPLACES, F.lit(False))
    records = stored(records, work_path(spark, "records"))
    touched = numbers_in(records.select(bucket_of(key, state.count).alias(BUCKET)), BUCKET)
    known = read_buckets(spark, path, state, touched).select(F.col(key).alias("_known"), F.struct(*arrival).alias("_arrived"))
    met = records.join(known, F.col(key) == F.col("_known"), "left").withColumn(REPLACES, F.col("_known").isNotNull())
    return met.where(~F.col(REPLACES) | (F.struct(*arrival) < F.col("_arrived"))).drop("_known", "_arrived")


def fitted(records: DataFrame, schema: T.StructType | None) -> tuple[DataFrame, T.StructType]:
    """Records in the types the index has, and its schema with the columns that are new."""
    known = {f.name: f.dataType for f in schema or ()}
    changed = {f.name: known[f.name].simpleString() for f in records.schema if f.name in known and f.dataType != known[f.name]}
    added = [T.StructField(f.name, f.dataType) for f in records.schema if f.name not in known]
    return (tolerant(records, changed) if changed else records), T.StructType([*(schema or ()), *added])


def upsert(
    path: str,
    records: DataFrame,
    key: str,
    arrival: Sequence[str] = (),
    buckets: int = 64,
    batch: str | None = None,
    only_new: bool = False,
    identity: Sequence[str] = (),
) -> None:
    """Put records into the index by id, the last of several with one id winning.

    Only the buckets the records fall into are written anew. With ``only_new`` no record's id is in the index yet; then
    the records are added as further parts of their buckets and nothing is rewritten. A ``batch``
    that is committed already, or an earlier one of its source (``source-number``), is left alone, so a job may run it again. New columns
    are added to the index; a value that does not fit its column's type becomes NULL. ``buckets`` counts for the
    first commit and stays for the life of an index. ``identity`` names the features that ``not_in_index`` will be asked by.
    Records with a column ``REPLACES`` say themselves which of them take a document's place: only the buckets of these are written anew.
    """
    spark = records.sparkSession
    state = read_state(spark, path)
    if batch:
        source, number = batch_number(batch)
        if state.batches.get(source, -1) >= number:
            return
    count = state.count or buckets
    latest = last_of_each(records, key, arrival) if arrival else records
    latest, schema = fitted(latest, state.schema)
    schema = T.StructType([f for f in schema if f.name != REPLACES])
    incoming = stored(latest.withColumn(BUCKET, bucket_of(key, count)), work_path(spark, "incoming"))
    touched = numbers_in(incoming, BUCKET)
    replaced = numbers_in(incoming.where(REPLACES), BUCKET) if REPLACES in incoming.columns else set() if only_new else touched
    incoming = incoming.drop(REPLACES)
    if not touched and state.schema == schema:
        return
    rewritten = {b for b in touched if b in replaced or len(state.buckets.get(b, ())) >= MOST_PARTS}
    merged = incoming
    if held := rewritten & state.buckets.keys():
        current = read_buckets(spark, path, replace(state, schema=schema), held)
        merged = upserted(current.withColumn(BUCKET, bucket_of(key, count)), incoming, key)
    folder = uuid.uuid4().hex
    # Rows of a bucket come together, but a large bucket is split over several tasks and files.
    merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    after = {b: [folder] if b in rewritten else [*state.buckets.get(b, []), folder] for b in touched}
    # Features that some commit left out are no longer those of every document.
    features = tuple(identity) if not state.buckets or state.identity == tuple(identity) else ()
    keys = add_keys(path, replace(state, schema=schema, count=count, identity=features), incoming, key, folder)
    commit = log_row(state.version + 1, batch, schema, features, count, after, keys)
    spark.createDataFrame([commit], LOG).coalesce(1).write.mode("append").json(f"{path}/log/{state.epoch}")
    if state.logged + 1 >= MOST_COMMITS:
        write_state(spark, path)


def add_keys(path: str, state: State, incoming: DataFrame, key: str, folder: str) -> dict[int, list[str]]:
    """Put the records into the table of identities; the folders of the buckets that this changes."""
    if not state.identity or state.identity == (key,):
        return {}
    spark = incoming.sparkSession
    features = identity_of(incoming, state.identity, state.schema)
    rows = incoming.select(*features, F.col(key).alias("document"))
    names = [c for c in rows.columns if c != "document"]
    bucket = F.pmod(F.xxhash64(*names), F.lit(state.count)).cast("int")
    touched = numbers_in(rows.select(bucket.alias(BUCKET)), BUCKET)
    together = {b for b in touched if len(state.keys.get(b, ())) >= MOST_PARTS}
    if together:
        rows = rows.unionByName(read_keys(spark, path, state, key, together)).distinct()
    rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/keys/{folder}")
    return {b: [folder] if b in together else [*state.keys.get(b, []), folder] for b in touched}


def write_state(spark: SparkSession, path: str) -> None:
    """Write the state out, one row per bucket; the log begins anew. A state that was not written whole is not read."""
    state = read_state(spark, path)
    spark.createDataFrame(state.rows(), STATE).coalesce(1).write.mode("overwrite").json(f"{path}/state/{state.epoch + 1}")
