"""Nested JSON documents of any size, read and written in parts (SC3 to SC8, SK5, SK6, X5).

Reading: Spark splits a document as text, at closing braces, so any file system will do and no task needs the whole. A first
pass tells for each block of the file whether it begins inside a string and how deep: quotes count by parity, and depths by the parity
before them, so blocks are summed up like numbers. A second pass cuts out studies, each a row; what lies across blocks is put together.

Writing: every object that opens or closes is a row with a sort key that puts it before, or after, what it holds. One range sort
brings all in order; whether a comma comes first shows in the row before. The text doesn't depend on the number of parts.
"""

from __future__ import annotations

import json
import re
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudica.operators.scale import numbered
from adjudica.schema import SOURCE_DDL
from adjudica.storage import written

#: Strings, an opened one that ends with the text, and brackets.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|"(?:[^"\\]|\\.)*\Z|[{}\[\]]', re.S)
#: Objects around a study: the document, its dataset and an institution.
STUDY_DEPTH = 3


_ESCAPED = re.compile(rb"\\.", re.S)
#: What the bytes of a document do: 1 for brackets that open, -1 for those that close, 2 for quotes.
_SIGNS = np.zeros(256, np.int8)
_SIGNS[list(b"{[")], _SIGNS[list(b"}]")], _SIGNS[ord('"')] = 1, -1, 2


def _signs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the brackets of a text are, how each changes the depth, and how many quotes by parity lie before it; the last entry is the end of the text, without change."""
    kinds = _SIGNS[np.frombuffer(_ESCAPED.sub(b"__", data) if b"\\" in data else data, np.uint8)]
    at = np.flatnonzero(kinds)
    signs = kinds[at]
    quotes = signs == 2
    parity = np.cumsum(quotes) & 1
    return np.append(at[~quotes], len(data)), np.append(signs[~quotes], 0), np.append(parity[~quotes], parity[-1] if len(parity) else 0)


def _depth_change(text: str | bytes) -> tuple[int, int, int]:
    """Quotes by parity, and how brackets change the depth if the text begins outside a string, or inside one."""
    _, change, parity = _signs(text.encode() if isinstance(text, str) else text)
    inside = int(change[parity == 1].sum())
    return int(parity[-1]), int(change.sum()) - inside, inside


def _runs_of(batch: pa.RecordBatch, columns: list[str]) -> list[tuple[int, int]]:
    """The slices of a batch's rows that are alike in some columns."""
    new = np.zeros(max(batch.num_rows - 1, 0), bool)
    for c in columns:
        own = batch.column(c)
        new |= np.asarray(pc.not_equal(own.slice(1), own.slice(0, len(new))).to_numpy(zero_copy_only=False), bool)
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def _ended_text(values: pa.Array) -> bytes:
    """Texts in a row, each with the brace that ended it."""
    if not len(values):
        return b""
    one = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.binary()))
    return pc.binary_join(one, pa.scalar(b"}", pa.binary()))[0].as_py() + b"}"


#: A document in files of its own has its blocks numbered by file and by place in the file, which has fewer bytes than this.
_FILE = 1 << 40


def _blocks(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """path, name, file, size, block (where a part of a document begins) and value: its text up to each closing brace, in order.

    paths lists documents, a file each; or it is the folder that write_documents() wrote, where the files of one source_json are a document.
    """
    meta = F.col("_metadata")
    read = spark.read.option("lineSep", "}")
    if isinstance(paths, str):
        lines = read.schema("value string, source_json string").text(paths)
        part = F.regexp_extract(meta["file_name"], r"^part-(\d+)", 1).cast("long")
        path, name, block = F.col("source_json"), F.col("source_json"), part * _FILE + meta["file_block_start"]
    else:
        lines, path, name, block = read.text(paths), meta["file_path"], meta["file_name"], meta["file_block_start"]
    return lines.select(path.alias("path"), name.alias("name"), meta["file_path"].alias("file"), meta["file_size"].alias("size"), block.alias("block"), "value")


_STATES = [("path", pa.string()), ("file", pa.string()), ("size", pa.int64()), ("block", pa.int64()), ("parity", pa.int32()), ("plain", pa.int32()), ("quoted", pa.int32()), ("bytes", pa.int64()), ("object", pa.bool_())]


@contextmanager
def _cut_by(spark: SparkSession, block_bytes: int | None):
    """Documents that are read meanwhile are cut into blocks of so many bytes; tables made of them are not."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if block_bytes:
        spark.conf.set(key, str(block_bytes))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: A task reads blocks one after another that have so many bytes together, or fewer, so that each core has some tasks.
TASK_BYTES, TASKS = 1 << 24, 4


def _dealt(lines: DataFrame, block_bytes: int | None) -> DataFrame:
    """The lines of small blocks with several blocks a task: a task for each would cost more than its block. No row moves, and a block's stay together."""
    if not block_bytes:
        return lines
    blocks = lines.rdd.getNumPartitions()
    tasks = max(-(-blocks * block_bytes // TASK_BYTES), TASKS * lines.sparkSession.sparkContext.defaultParallelism)
    return lines.coalesce(tasks) if tasks < blocks else lines


def block_states(spark: SparkSession, paths: list[str] | str, block_bytes: int | None = None) -> DataFrame:
    """path, block, inside, depth, bare, whole: how each block of a document begins; whole tells whether the document is one object that ends.

    bare: the last text of the block is the end of a file without a brace. A window goes over the blocks of one document, a row of numbers each.
    """
    def summed(stream):
        at, total = None, None
        for batch in stream:
            out = []
            for a, b in _runs_of(batch, ["path", "file", "size", "block"]):
                own, values = tuple(batch.column(c)[a].as_py() for c in ("path", "file", "size", "block")), batch.column("value").slice(a, b - a)
                if own != at:
                    if at is not None:
                        out.append((*at, *total))
                    at, total = own, (0, 0, 0, 0, values[0].as_py().lstrip("\ufeff \t\r\n").startswith("{"))
                text = _ended_text(values)
                parity, plain, quoted = _depth_change(text)
                first, second = (plain, quoted) if total[0] == 0 else (quoted, plain)
                total = ((total[0] + parity) % 2, total[1] + first, total[2] + second, total[3] + len(text), total[4])
            yield _batch(out, _STATES)
        if at is not None:
            yield _batch([(*at, *total)], _STATES)

    with _cut_by(spark, block_bytes):
        found = written(_dealt(_blocks(spark, paths), block_bytes).mapInArrow(summed, _ddl(_STATES)), "block-sums")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every, own = Window.partitionBy("path"), Window.partitionBy("path", "file")
    found = found.withColumn("_left", F.col("size") - F.sum("bytes").over(own))  # -1 where what follows a file's last brace reads as if it had one, too
    found = found.withColumn("bare", (F.col("_left") == -1) & (F.col("block") == F.max("block").over(own)))
    # the brace that isn't there closed nothing, if it came outside a string
    found = found.withColumn("plain", F.col("plain") + F.when(F.col("bare") & (F.col("parity") == 0), 1).otherwise(0)).withColumn("quoted", F.col("quoted") + F.when(F.col("bare") & (F.col("parity") == 1), 1).otherwise(0))
    found = found.withColumn("inside", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2).withColumn("_change", F.when(F.col("inside") == 0, F.col("plain")).otherwise(F.col("quoted")))
    read = (F.min("_left").over(every) >= -1) & (F.max("_left").over(every) <= 0)
    whole = read & (F.sum("parity").over(every) % 2 == 0) & (F.sum("_change").over(every) == 0) & F.min_by("object", "block").over(every)
    return found.select("path", "block", (F.col("inside") == 1).alias("inside"), F.coalesce(F.sum("_change").over(before), F.lit(0)).cast("int").alias("depth"), "bare", whole.alias("whole"))


_RECORDS = [("path", pa.string()), ("name", pa.string()), ("block", pa.int64()), ("nth", pa.int64()), ("edge", pa.bool_()), ("text", pa.string()), ("top", pa.string()), ("institution", pa.string()), ("study", pa.string())]


def _ddl(kinds: list[tuple[str, pa.DataType]]) -> str:
    return ", ".join(f"{n} { {pa.int64(): 'long', pa.int32(): 'int', pa.bool_(): 'boolean'}.get(k, 'string')}" for n, k in kinds)


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


class _Cutter:
    """Cuts a block into records, each what follows a study up to the end of the next one."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth, self.held = inside, depth, []

    def feed(self, data: bytes) -> list[str]:
        """The records that end in this part of the block, whose texts end with their braces."""
        at, change, parity = _signs(data)
        change = np.where((parity == 1) == self.inside, change, 0)  # brackets in strings are none
        depth = self.depth + np.cumsum(change)
        ends = at[:-1][(change == -1)[:-1] & (depth == STUDY_DEPTH)[:-1]] + 1
        out, start = [], 0
        for end in ends.tolist():
            if data[end - 1 : end] == b"}":
                out.append(b"".join([*self.held, data[start:end]]).decode())
                self.held, start = [], end
        self.held.append(data[start:])
        self.inside, self.depth = self.inside != bool(parity[-1]), int(depth[-1])
        return out

    def left(self) -> str:
        return b"".join(self.held).decode()


def _names(record: str, depth: int) -> tuple[str | None, str | None, str | None, str | None]:
    """The keys at depths 1, 2 and 3 that a record names before its study, and the study's text; no study without an object at that depth."""
    keys: dict[int, str | None] = {}
    last = None
    for token in _TOKEN.finditer(record):
        t = token.group()
        if t[0] == '"':
            last = t
        elif t in "{[":
            if last is not None and t == "{":
                keys[depth] = _unquoted(last)
            depth += 1
            if depth == STUDY_DEPTH + 1 and t == "{":
                return keys.get(1), keys.get(2), keys.get(3), record[token.start() :]
            last = None
        else:
            depth -= 1
    return keys.get(1), keys.get(2), None, None


def _unquoted(string: str) -> str | None:
    try:
        return json.loads(string)
    except ValueError:
        return None


def studies(spark: SparkSession, paths: list[str] | str, institutions: list[str] | None = None, block_bytes: int | None = None) -> DataFrame:
    """source_json, institution, study and s, the study's struct, of documents that are read in parts.

    paths lists documents, or is the folder of write_documents(). A document whose brackets or quotes don't end gives no rows (rejected() names it). With institutions only theirs are parsed.
    The rows are those of nested.studies_of(nested.documents()). A study is one row, however many blocks it lies across; a key that
    comes twice in one object is two rows here. A document is cut into blocks as Spark cuts files, or of block_bytes. What is broadcast is a row of
    numbers for each block: a terabyte of documents has some 8,000.
    """
    states = written(block_states(spark, paths, block_bytes), "blocks").filter("whole").select(F.col("path").alias("_path"), F.col("block").alias("_block"), "inside", "depth", "bare")
    def cut(stream):
        at = cutter = name = held = None
        bare, nth, known = False, 0, [None, None]

        def fed(data):
            nonlocal nth, known
            for record in cutter.feed(data):
                if nth == 0:
                    yield (at[0], name, at[1], nth, True, record, None, None, None)
                else:
                    top, institution, study, text = _names(record, STUDY_DEPTH)
                    known = [known[0], institution or known[1]] if top is None else [top, institution]
                    yield (at[0], name, at[1], nth, False, text, *known, study)
                nth += 1

        def ended():
            return [*fed(held if bare else held + b"}"), (at[0], name, at[1], nth, True, cutter.left(), None, None, None)] if cutter else []

        for batch in stream:
            out = []
            for a, b in _runs_of(batch, ["path", "block"]):
                own, values = (batch.column("path")[a].as_py(), batch.column("block")[a].as_py()), batch.column("value").slice(a, b - a)
                before = b""
                if own != at:
                    out += ended()
                    inside, depth = batch.column("inside")[a].as_py(), batch.column("depth")[a].as_py()
                    at, name, bare, nth, known, cutter = own, batch.column("name")[a].as_py(), batch.column("bare")[a].as_py(), 0, [None, None], _Cutter(inside, depth)
                else:
                    before = held + b"}"
                out += fed(before + _ended_text(values.slice(0, b - a - 1)))
                held = values[b - a - 1].as_py().encode()  # the last text of a block may have no brace
            yield _batch(out, _RECORDS)
        yield _batch(ended(), _RECORDS)

    with _cut_by(spark, block_bytes):
        lines = _dealt(_blocks(spark, paths), block_bytes)
        # the state of a block comes to its lines, which stay in their order
        lines = lines.join(F.broadcast(states), (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block"))).select("path", "name", "block", "inside", "depth", "bare", "value")
        found = written(lines.mapInArrow(cut, _ddl(_RECORDS)), "records")
    counts = found.groupBy("path", "block").agg(F.max("nth").alias("_last"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("path").alias("_path"), F.col("block").alias("_block"), F.coalesce(F.sum("_last").over(before), F.lit(0)).alias("_start"))
    placed = found.join(F.broadcast(starts), (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block"))).withColumn("place", F.col("nth") + F.col("_start")).drop("_path", "_block", "_start")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "nth", "text"))), lambda p: p["text"])
    edges = placed.filter("edge").groupBy("path", "name", "place").agg(F.array_join(pieces, "").alias("text"))
    kind = "struct<top:string,institution:string,study:string,text:string>"
    named = F.udf(lambda text, first: _names(text, 0 if first else STUDY_DEPTH), kind)
    edges = written(edges.withColumn("_n", named("text", F.col("place") == 0)).select("path", "name", "place", "_n.*"), "edges")
    # names that a block takes over from those before it: of the edges and of each block's last record, in order
    hints = placed.filter("not edge").groupBy("path", "block").agg(F.max_by(F.struct("place", "top", "institution"), "place").alias("_h")).select("path", "_h.*")
    small = edges.select("path", "place", "top", "institution").unionByName(hints)
    until = Window.partitionBy("path").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    carried = small.select("path", "place", F.last("top", True).over(until).alias("_top"), F.last("institution", True).over(until).alias("_institution"))
    own = carried.select(F.col("path").alias("_path"), F.col("place").alias("_place"), "_top", "_institution")
    at_edge = edges.join(own, (F.col("path") == F.col("_path")) & (F.col("place") == F.col("_place"))).select("path", "name", "place", F.col("_top").alias("top"), F.col("_institution").alias("institution"), "study", "text")
    first = starts.withColumnRenamed("_start", "_place").join(own, ["_path", "_place"]).select("_path", "_block", "_top", "_institution")
    inner = placed.filter("not edge").join(F.broadcast(first), (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block")))
    inner = inner.select("path", "name", "place", F.coalesce("top", "_top").alias("top"), F.coalesce("institution", "_institution").alias("institution"), "study", "text")
    whole = inner.unionByName(at_edge).filter("top = 'dataset' and study is not null")
    if institutions is not None:
        whole = whole.filter(F.col("institution").isin(list(institutions)))
    return whole.select(F.col("name").alias("source_json"), "institution", "study", F.from_json("text", study_schema()).alias("s"))


def study_schema() -> T.StructType:
    return T.StructType.fromDDL(SOURCE_DDL)["dataset"].dataType.valueType.valueType


def rejected(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """path of documents whose brackets or quotes don't end: no rows come of them."""
    return block_states(spark, paths).filter("not whole").select("path").distinct()


# ---------------------------------------------------------------- writing


def _quoted(text: Column) -> Column:
    """A JSON string."""
    inside = F.to_json(F.array(text))
    return F.substring(inside, F.lit(2), F.length(inside) - 2)


def _members(value: Column) -> Column:
    """The members of a JSON object, with a comma after them; nothing for an empty or null one."""
    inside = F.trim(F.substring(value, F.lit(2), F.length(value) - 2))
    return F.when(F.coalesce(F.length(inside), F.lit(0)) == 0, F.lit("")).otherwise(F.concat(inside, F.lit(",")))


_LEVELS = ("source_json", "institution", "study", "series", "file")
_OPENS = {1: ("{", '"dataset":{'), 2: ("{", ""), 3: ("{", '"series_list":{'), 4: ("{", '"file_list":{')}
_CLOSES = {1: "}}", 2: "}", 3: "}}", 4: "}}"}


def document_lines(files: DataFrame, documents: DataFrame | None = None, study: DataFrame | None = None, series: DataFrame | None = None) -> DataFrame:
    """source_json, n and text: pieces whose texts, in the order of n, are the documents one after another; keys are sorted.

    files has a row for each file: the five names and value, a JSON object. documents, study and series have the names down to their level and
    members, a JSON object whose members the object holds besides; a level without files is left out. Names must not be null.
    """
    def key(depth: int, late: bool) -> Column:
        steps = [F.struct(F.lit(0).alias("late"), F.col(c).alias("name")) for c in _LEVELS[:depth]]
        return F.array(*steps, *([F.struct(F.lit(1).alias("late"), F.lit("").alias("name"))] if late else []))

    parts = [files.select("source_json", key(5, False).alias("key"), F.lit("item").alias("kind"), F.concat(_quoted(F.col("file")), F.lit(":"), F.col("value")).alias("text"))]
    members = {1: documents, 3: study, 4: series}
    for depth in range(1, 5):
        names = list(_LEVELS[:depth])
        group = files.select(*names).distinct()
        own = members.get(depth)
        inside = F.lit("")
        if own is not None:
            own = own.select(*[F.col(c).alias(f"_m_{c}") for c in names], F.col("members").alias("_members"))
            group = group.join(own, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_m_{c}") for c in names]), "left")
            inside = _members(F.col("_members"))
        name = F.lit("") if depth == 1 else F.concat(_quoted(F.col(names[-1])), F.lit(":"))
        begin, end = _OPENS[depth]
        parts.append(group.select("source_json", key(depth, False).alias("key"), F.lit("open").alias("kind"), F.concat(name, F.lit(begin), inside, F.lit(end)).alias("text")))
        parts.append(group.select("source_json", key(depth, True).alias("key"), F.lit("close").alias("kind"), F.lit(_CLOSES[depth]).alias("text")))
    ordered = numbered(reduce(DataFrame.unionByName, parts), ["key"], "n")
    before = ordered.select((F.col("n") + 1).alias("_n"), F.col("kind").alias("_before"), F.col("source_json").alias("_document"))
    both = ordered.join(before, F.col("n") == F.col("_n"), "left")
    comma = (F.col("kind") != "close") & (F.col("_before") != "open") & (F.col("_document") == F.col("source_json"))
    return both.select("source_json", "n", F.concat(F.when(F.coalesce(comma, F.lit(False)), F.lit(",")).otherwise(F.lit("")), F.col("text")).alias("text"))


def write_documents(lines: DataFrame, folder: str, parts: int | None = None) -> None:
    """A folder for each document, source_json=<name>, whose files in the order of their names are its text, a piece a line.

    The text is cut into up to so many parts, or as many as Spark deals ranges to, so that no task writes a document alone. studies() reads the folder.
    """
    ranges = ["source_json", "n"] if parts is None else [parts, "source_json", "n"]
    ranged = lines.repartitionByRange(*ranges).sortWithinPartitions("source_json", "n")
    # a task writes one file of a document: its number is the file's place
    ranged.select("source_json", "text").write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy("source_json").text(folder)
