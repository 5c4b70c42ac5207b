"""Landing: source files as all-text tables, without cleaning and without losing rows."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

_BAD_LINE = "__unparsed_line"
# A whole quoted field, and a quoted field that its line does not end.
_QUOTED = r'(^|,)"(?:[^"]|"")*"(?=,|$)'
_OPEN_QUOTE = r'(^|,)"'
# The rest of a quoted field up to its closing quote.
_REST_OF_FIELD = re.compile(r'(?:[^"]|"")*+"')

# The driver keeps the places of file blocks that begin inside a quoted field, as it keeps those of all blocks to
# scan them; more than so many raise. With blocks of 128 MB these are 128 TB.
MOST_OPEN_BLOCKS = 1_000_000
# Records without declared columns name at most so many.
MOST_KEYS = 10_000


@dataclass(frozen=True)
class Source:
    """A feed and what is declared about it: a field may hold line breaks, records have these columns."""

    table: str
    path: str
    fmt: str = "csv"
    multiline: bool = False
    columns: tuple[str, ...] | None = None


# The five feeds, where they lie under the landing root, and the keys of the JSON records.
SOURCES = (
    Source("raw_customers", "crm/customers.csv"),
    Source("raw_products", "catalog/products.csv"),
    Source("raw_orders", "orders/orders.csv"),
    Source("raw_order_lines", "orders/order_lines.csv"),
    Source(
        "raw_web_events",
        "web/events.jsonl",
        fmt="jsonl",
        columns=("event_id", "customer_id", "event_type", "occurred_at", "session_id", "device"),
    ),
)


def land_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A CSV file or folder as text columns named by its header.

    An empty field is ``''`` and a field missing at the end of a short line is
    NULL; surplus fields are dropped. Only a line without any character is
    skipped; a line of spaces is a short record. Every file of a folder begins
    with the same header.

    ``multiline`` declares that a quoted field may hold a line break (records
    then end with LF or CRLF); a record that breaks the declaration raises. Both
    ways files are split between tasks and give the same rows.
    """
    names = spark.read.options(header=True, escape='"').csv(path).columns
    if not names:
        raise ValueError(f"{path} has no header row")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BAD_LINE]])
    options = {"escape": '"', "emptyValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_LINE, "multiLine": str(multiline)}
    # Spark's own line reader would skip lines of spaces, so records come as text and are parsed one by one.
    if multiline:
        record = _records(spark, path, names)
    else:
        body = _lines(spark, path).where("value != ''").mapInArrow(_without_headers(names), "value string")
        spans = F.raise_error(F.concat(F.lit("a quoted field spans lines, declare the source multiline: "), "value"))
        record = body.select(F.when(_is_open(F.col("value")), spans).otherwise(F.col("value")).alias("value"))
    lines = record.select(F.from_csv("value", _ddl(schema), options).alias("r")).select("r.*")
    # The parser yields NULL for an empty and for a missing field alike. Only a
    # line with too few or too many fields keeps its text, and the delimiters
    # outside quotes then tell how many fields it has.
    bare = F.regexp_replace(F.col(_BAD_LINE), _QUOTED, "$1")
    present = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return lines.select(
        *[
            F.when(F.col(_BAD_LINE).isNull() | (present > i), F.coalesce(F.col(f"`{n}`"), F.lit(""))).alias(n)
            for i, n in enumerate(names)
        ]
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` string" for f in schema.fields)


def _is_open(line: Column) -> Column:
    """True for a line that ends inside a quoted field."""
    return F.contains(line, F.lit('"')) & F.regexp_replace(line, _QUOTED, "$1").rlike(_OPEN_QUOTE)


def _lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines with the file and block that they come from; those of one block come together and in order."""
    return spark.read.options(**options).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def _check_header(record: str, names: Sequence[str], file: str) -> None:
    import csv

    header = next(csv.reader([record.removeprefix("\ufeff")]))
    if header != list(names):
        raise ValueError(f"{file} has the header {header}, not {list(names)}")


def _without_headers(names: Sequence[str]):
    """Drops the first line of every file, which must be the header; nothing but a file's first line is one.

    Rows of one file part come together and in order, but no built-in function
    knows which of them comes first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            values, files, starts = (batch.column(c) for c in ("value", "file", "start"))
            # Only rows that begin a file part are looked at one by one.
            turns = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(starts[1:], starts[:-1]))
            headers = []
            for i in [0, *(turn + 1 for turn in pc.indices_nonzero(turns).to_pylist())] if batch.num_rows else []:
                part = files[i].as_py(), starts[i].as_py()
                if part != last and part[1] == 0:
                    _check_header(values[i].as_py(), names, part[0])
                    headers.append(i)
                last = part
            if headers:
                keep = [True] * batch.num_rows
                for i in headers:
                    keep[i] = False
                values = pc.filter(values, pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([values], names=["value"])

    return run


def _ends_open(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field, if it begins inside one or not.

    A field is quoted if a quote opens it. The first quote that isn't doubled
    ends it, whatever follows up to the delimiter.
    """
    if '"' not in line:
        return inside
    at = 0
    if not inside and not line.startswith('"'):
        at = line.find(',"') + 2
        if at == 1:
            return False
    elif not inside:
        at = 1
    while True:
        closed = _REST_OF_FIELD.match(line, at)
        if closed is None:
            return True
        at = line.find(',"', line.find(",", closed.end())) + 2 if "," in line[closed.end() :] else 1
        if at == 1:
            return False


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per file block whether it ends inside a quoted field, if it begins outside and if it begins inside one."""

    def row(part, states):
        return pa.RecordBatch.from_pylist([{"file": part[0], "start": part[1], "outside": states[0], "inside": states[1]}])

    last, states = None, (False, True)
    for batch in batches:
        values, files, starts = (batch.column(c).to_pylist() for c in ("value", "file", "start"))
        for value, part in zip(values, zip(files, starts)):
            if part != last:
                if last is not None:
                    yield row(last, states)
                last, states = part, (False, True)
            if '"' in value:
                states = tuple(_ends_open(value, state) for state in states)
    if last is not None:
        yield row(last, states)


def _open_blocks(lines: DataFrame) -> dict[str, set[int]]:
    """Per file the blocks that begin inside a quoted field.

    A block leaves the state as it is, turns it over, or sets it. So the state
    after a block is the last one set, turned over as often as blocks since do.
    """
    blocks = lines.mapInArrow(_summaries, "file string, start long, outside boolean, inside boolean")
    order = Window.partitionBy("file").orderBy("start")
    so_far = lambda window: window.rowsBetween(Window.unboundedPreceding, 0)
    sets, turns = F.col("outside") == F.col("inside"), F.col("outside") & ~F.col("inside")
    since = Window.partitionBy("file", "era").orderBy("start")
    state = F.when(F.col("era") == 0, False).otherwise(F.first("outside").over(since))
    turned = F.sum(turns.cast("int")).over(so_far(since)) % 2 == 1
    after = blocks.withColumn("era", F.sum(sets.cast("int")).over(so_far(order))).withColumn("after", state != turned)
    inside = after.withColumn("before", F.lag("after", 1, False).over(order)).where("before").select("file", "start")
    found = inside.limit(MOST_OPEN_BLOCKS + 1).collect()
    if len(found) > MOST_OPEN_BLOCKS:
        raise ValueError(f"more than {MOST_OPEN_BLOCKS} file blocks begin inside a quoted field")
    out: dict[str, set[int]] = {}
    for r in found:
        out.setdefault(r.file, set()).add(r.start)
    return out


def _assembler(names: Sequence[str], opened: Mapping[str, set[int]]):
    """Lines to records: whole ones (part 0), the rest of one that an earlier block began (1), the beginning of one (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, rest = None, [], False
        for batch in batches:
            out = []
            values, files, starts = (batch.column(c).to_pylist() for c in ("value", "file", "start"))
            for value, part in zip(values, zip(files, starts)):
                if part != last:
                    if held:
                        out.append(("\n".join(held), *last, 1 if rest else 2))
                    header, held = part[1] == 0, []
                    last, rest = part, part[1] in opened.get(part[0], ())
                    inside = rest
                if not inside and value in ("", "\r"):
                    continue
                held.append(value)
                inside = _ends_open(value, inside)
                if inside:
                    continue
                record, held = "\n".join(held).removesuffix("\r"), []
                if header:
                    _check_header(record, names, part[0])
                else:
                    out.append((record, *part, int(rest)))
                header = rest = False
            yield _fragments(out)
        if held:
            yield _fragments([("\n".join(held), *last, 1 if rest else 2)])

    return run


def _fragments(rows: list[tuple[str, str, int, int]]) -> pa.RecordBatch:
    kinds = {"value": pa.string(), "file": pa.string(), "start": pa.int64(), "part": pa.int32()}
    columns = zip(*rows) if rows else ([],) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def _records(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The records of CSV files whose quoted fields may hold line breaks, as text, without headers.

    A first pass finds the blocks that begin inside a field. With them every task
    puts together the records of its own blocks; a record over several blocks
    comes in fragments that belong to the block where it begins. Without such
    blocks only the end of a file can leave a fragment.
    """
    lines = _lines(spark, path, lineSep="\n")
    opened = _open_blocks(lines)
    pieces = lines.mapInArrow(_assembler(names, opened), "value string, file string, start long, part int")
    if not opened:
        return pieces.select("value")
    split = pieces.where("part != 0")
    before = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
    # Within a block the rest of an earlier record comes before the beginning of the next.
    owner = F.last(F.when(F.col("part") == 2, F.col("start")), ignorenulls=True).over(before)
    ordered = F.sort_array(F.collect_list(F.struct("start", "value")))
    joined = split.withColumn("owner", owner).groupBy("file", "owner").agg(ordered.alias("all"))
    stitched = joined.select(F.array_join(F.transform("all", lambda x: x["value"]), "\n").alias("value"))
    return pieces.where("part = 0").select("value").unionByName(stitched.select(F.rtrim("value", F.lit("\r")).alias("value")))


def record_keys(spark: SparkSession, path: str) -> list[str]:
    """The keys that occur in any record, by name."""
    records = spark.read.text(path).where(F.trim("value") != "")
    keys = records.select(F.explode_outer(F.json_object_keys("value")).alias("key")).distinct().limit(MOST_KEYS + 1).collect()
    if not keys:
        raise ValueError(f"{path} is empty")
    if len(keys) > MOST_KEYS:
        raise ValueError(f"{path} has more than {MOST_KEYS} different keys: declare the columns of the source")
    return sorted(r["key"] for r in keys if r["key"] is not None)


def land_jsonl(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """JSON lines as text columns; without declared ``columns`` every key of any record is one.

    Blank lines are skipped, a missing key or JSON null is ``''``, numbers keep
    the text they have in the file and a malformed line raises.
    """
    names = list(columns) if columns else record_keys(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    records = spark.read.schema(schema).options(mode="FAILFAST").json(path)
    return records.select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])


def land(spark: SparkSession, root: str, source: Source) -> DataFrame:
    path = f"{root.rstrip('/')}/{source.path}"
    return land_jsonl(spark, path, source.columns) if source.fmt == "jsonl" else land_csv(spark, path, source.multiline)


def land_all(spark: SparkSession, root: str, sources: Sequence[Source] = SOURCES) -> dict[str, DataFrame]:
    """Every source by table name. A path that does not exist raises here."""
    return {s.table: land(spark, root, s) for s in sources}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row (table, rows) per table, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
