"""Monthly readings from many CSV files whose headers differ.

Spark's CSV reader with ``header=true`` takes column names from one file and
applies them by position to every file, which misplaces columns when files
differ. This reader aligns each file by its own header, without Python
workers. One rule holds for every file, whatever its size: the header is the
first line that names a known column and holds no numeric-looking field;
lines before it, blank lines and later header lines are not data; a file
without such a line has no data (``headerless_files`` reports it). Two modes
give the same rows:

* **Whole files** (small ones). Each file is read as one row (``wholetext``)
  and split into lines; the column positions are taken from its header once
  per file, and the lines after it are exploded and picked by position. One
  pass with no join and no shuffle, and each file is opened once. A task
  holds one file at a time.
* **Lines** (files too large to be one row). ``read.text`` gives one row per
  line with its file and block; a line's place in its file is its block's
  start and its number within the task. Header lines give a small per-file
  table of positions, joined back on the path and a salt of the block, so a
  huge file is not one join key. Spark picks the join from run-time sizes.

In both modes lines are split into unquoted CSV fields by a linear regex.
Data lines carry a ``yyyy-MM`` date, so they are told from headers by a cheap
test on the raw text before any split. Picking uses ``get``, which is null
when a column is absent or a ragged line is short. Values are cast with
``try_cast``, so bad numbers become null, and so do ``NaN`` and infinite ones.

**Line breaks within quotes** (``quoted_breaks=True``): a line break after an odd
number of quotes of its file belongs to its field. Whole files are cut into
records by a linear regex. Lines of large files are joined again from a parity
scan, whatever the splits: blocks are cut into chunks of lines, each chunk's quotes
are counted, and a running sum over the chunks of a file (a small table) gives the
parity its first line starts with. Each chunk's lines are packed into one row,
shuffled so, and cut into records by a linear regex. Only records that go across
chunk and block edges are grouped. The header's positions are joined to the table
of chunks, so lines are shuffled once. A file
whose quotes do not pair up has no such records: its lines are taken as they
are, so a stray quote cannot swallow the rest of it. The breaks become ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType, StructType

from isotherm.functions.text import csv_fields
from isotherm.schemas import HEADER_MARKER, READINGS_SCHEMA
from isotherm.sources.listing import STEM_PATTERN, file_listing


# Files up to this size are read whole, larger ones line by line: the cost of
# opening a file outweighs reading it about there. Both modes give the same rows.
WHOLE_FILE_BYTES = 4 << 20
# Large files: a block's lines join the header table under one of this many salts.
HEADER_SALTS = 32
_BLOCK_BYTES = 64 << 20
# Line breaks within quotes: a chunk of a block has at most 2 to the power of this many lines, which are one row of a shuffle.
CHUNK_BITS = 12


# A field that starts like a number (optionally quoted). Every data line has
# one (its yyyy-MM date); a header line has none.
_NUMERIC_FIELD = r'(^|,)\s*"?\s*[-+]?[0-9.]'


def header_candidate(line: Column) -> Column:
    """Cheap test on the raw line: no field starts like a number."""
    return ~line.rlike(_NUMERIC_FIELD)


def header_predicate(fields: Column, names: list[str]) -> Column:
    """A header line names at least one known column and has no numeric-looking
    field (every data line carries a ``yyyy-MM`` date and numbers)."""
    known = F.exists(fields, lambda x: x.isin(*names))
    numeric = F.exists(fields, lambda x: x.rlike(r"^\s*[-+]?[0-9.]"))
    return known & ~numeric


def _number(value: Column, kind: DataType) -> Column:
    """Null instead of NaN and the infinities, which no mean could carry."""
    if not isinstance(kind, (FloatType, DoubleType)):
        return value
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def _pick(schema: StructType, keep_path: bool, flag_ragged: bool) -> list[Column]:
    """Target columns from fields ``_f`` and per-file positions ``_pos<i>`` / ``_width``."""
    cols = []
    for i, f in enumerate(schema.fields):
        value = F.nullif(F.get(F.col("_f"), F.col(f"_pos{i}") - 1), F.lit(""))
        if isinstance(f.dataType, StringType):
            cols.append(value.alias(f.name))
        else:
            cols.append(_number(F.trim(value).try_cast(f.dataType), f.dataType).alias(f.name))
    if keep_path:
        cols.append(F.col("_path").alias("source_file"))
    if flag_ragged:
        cols.append((F.size("_f") != F.col("_width")).alias("ragged"))
    return cols


def _positions(fields: Column, names: list[str]) -> list[Column]:
    return [F.size(fields).alias("_width")] + [
        F.array_position(fields, F.lit(c)).cast("int").alias(f"_pos{i}") for i, c in enumerate(names)
    ]


def align_files(files: DataFrame, schema: StructType = READINGS_SCHEMA,
                header_marker: str = HEADER_MARKER, keep_path: bool = False,
                flag_ragged: bool = False, quoted_breaks: bool = False) -> DataFrame:
    """Align whole CSV files ``(_path, _content)``, one row per file, by their own header.

    Works on a batch frame and on a streaming micro-batch alike.
    """
    names = [f.name for f in schema.fields]
    known = [header_marker, *names]
    with_header = _with_header(files, known, quoted_breaks)
    # The header test goes into the generator input rather than a filter: a
    # filter would be pushed below the projection with the file's split
    # inlined, repeating the split of the whole content per reference.
    after = F.slice("_lines", F.col("_at") + 1, F.size("_lines"))
    exploded = with_header.select(
        "_path", *_positions(csv_fields("_hdr"), names), F.explode(F.when(F.col("_at") > 0, after)).alias("_line"))
    # Every line but blank lines and headers (a file may repeat its header line).
    fields = exploded.filter(F.trim(F.col("_line")) != "").select(
        "*", header_candidate(F.col("_line")).alias("_cand"), csv_fields("_line").alias("_f"))
    data = fields.filter(~(F.col("_cand") & header_predicate(F.col("_f"), known)))
    return data.select(*_pick(schema, keep_path, flag_ragged))


# A record with line breaks between quotes. Possessive, so linear in its length; never empty.
_RECORD = r'([^"\n]++(?:"[^"]*+"[^"\n]*+)*+|(?:"[^"]*+"[^"\n]*+)++)'


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, '"', ""))


def _records(content: Column) -> Column:
    """The records of a whole file, without empty lines."""
    one_kind = F.regexp_replace(content, "\r\n?", "\n")
    return F.when(_quotes(content) % 2 == 0, F.regexp_extract_all(one_kind, F.lit(_RECORD), F.lit(1)))


def _with_header(files: DataFrame, known: list[str], quoted_breaks: bool = False) -> DataFrame:
    """``(_path, _lines, _hdr, _at)``: the lines of each whole file, its header line and that line's number (0: none)."""
    # Splitting on runs of line breaks drops empty lines; lines holding only
    # blanks are dropped per row after the explode.
    lines = F.split(F.regexp_replace(F.col("_content"), r"^[\r\n]+", ""), r"[\r\n]+", -1)
    if quoted_breaks:
        lines = F.coalesce(_records(F.col("_content")), lines)
    is_header = lambda x: header_candidate(x) & header_predicate(csv_fields(x), known)
    found = files.select("_path", lines.alias("_lines")).withColumn("_hdr", F.get(F.filter("_lines", is_header), 0))
    return found.withColumn("_at", F.coalesce(F.array_position("_lines", F.col("_hdr")).cast("int"), F.lit(0)))


def align_lines(lines: DataFrame, schema: StructType = READINGS_SCHEMA,
                header_marker: str = HEADER_MARKER, keep_path: bool = False,
                flag_ragged: bool = False, quoted_breaks: bool = False) -> DataFrame:
    """Align CSV text lines ``(_path, _block, _number, _line)`` by each file's own header.

    ``(_block, _number)`` orders the lines of a file. Works on a batch frame
    and on a persisted streaming micro-batch alike.
    """
    names = [f.name for f in schema.fields]
    known = [header_marker, *names]
    place = F.struct("_block", "_number")
    headers = _header_lines(joined_records(lines) if quoted_breaks else lines, known).groupBy("_path").agg(
        F.min_by(F.struct(*_positions(F.col("_f"), names), place.alias("_at")), place).alias("_h"))
    if quoted_breaks:
        return _data_lines(joined_records(lines, headers.select("_path", "_h.*")), known, place).select(*_pick(schema, keep_path, flag_ragged))
    salted = headers.select("_path", "_h.*", F.explode(F.sequence(F.lit(0), F.lit(HEADER_SALTS - 1))).alias("_salt"))
    # Data lines are recognised on the raw text before splitting, so the
    # header test short-circuits for them.
    fields = lines.filter(F.trim(F.col("_line")) != "").select(
        "_path", place.alias("_place"), F.pmod(F.floor(F.col("_block") / _BLOCK_BYTES), F.lit(HEADER_SALTS)).cast("int").alias("_salt"),
        header_candidate(F.col("_line")).alias("_cand"), csv_fields("_line").alias("_f"))
    data = fields.filter(~(F.col("_cand") & header_predicate(F.col("_f"), known)))
    return data.join(salted, ["_path", "_salt"]).filter(F.col("_place") > F.col("_at")).select(
        *_pick(schema, keep_path, flag_ragged))


def _data_lines(lines: DataFrame, known: list[str], place: Column) -> DataFrame:
    """The lines, split, that hold data: after the header's place ``_at``, neither blank nor a header."""
    fields = lines.filter((F.trim(F.col("_line")) != "") & (place > F.col("_at"))).select(
        "*", header_candidate(F.col("_line")).alias("_cand"), csv_fields("_line").alias("_f"))
    return fields.filter(~(F.col("_cand") & header_predicate(F.col("_f"), known)))


_CHUNK = ["_path", "_block", "_chunk"]


def _chunked(lines: DataFrame) -> DataFrame:
    """The lines with their chunk and whether their quotes are odd."""
    # Numbers rise within a block, so those of one chunk follow each other.
    chunk = F.shiftright("_number", CHUNK_BITS).alias("_chunk")
    return lines.select("_path", "_block", chunk, "_number", "_line", (_quotes(F.col("_line")) % 2).cast("int").alias("_odd"))


def _chunk_parities(lines: DataFrame) -> DataFrame:
    """Per chunk of a file: whether it starts and ends within quotes, and the chunk of the last record begun before it.

    One row per chunk, so the windows over a file hold few rows.
    """
    odd = F.col("_odd")
    chunks = lines.groupBy(*_CHUNK).agg(
        F.sum(odd).alias("_n_odd"), F.min("_number").alias("_number"), F.max("_number").alias("_last"),
        F.min(F.when(odd == 1, F.col("_number"))).alias("_first_odd"))
    in_file = Window.partitionBy("_path")
    before = in_file.orderBy("_block", "_chunk", "_number").rowsBetween(Window.unboundedPreceding, -1)
    paired = F.sum("_n_odd").over(in_file) % 2 == 0
    start = F.when(paired, F.coalesce(F.sum("_n_odd").over(before), F.lit(0)) % 2).otherwise(0)
    placed = chunks.withColumn("_paired", paired).withColumn("_start", start)
    # A chunk that starts within quotes begins a record of its own if a line follows the one that closes them.
    begins = (F.col("_start") == 0) | F.coalesce(F.col("_first_odd") < F.col("_last"), F.lit(False))
    return placed.select(
        *_CHUNK, "_number", "_paired", "_start", F.when(F.col("_paired"), (F.col("_start") + F.col("_n_odd")) % 2).otherwise(0).alias("_end"),
        F.last(F.when(begins, F.struct("_block", "_chunk")), ignorenulls=True).over(before).alias("_owner"))


# A record after its line break, possibly empty. Possessive, so linear in its length.
_NEXT_RECORD = r'\n([^"\n]*+(?:"[^"]*+"[^"\n]*+)*+)'


def joined_records(lines: DataFrame, of_files: DataFrame | None = None) -> DataFrame:
    """Lines ``(_path, _block, _number, _line)`` with those of one quoted record joined, in the order of their places.

    A chunk's lines are packed into one row before the shuffle, which carries
    the path once a chunk, and are cut into records as one text: with a quote
    put before a chunk that starts within quotes and one after a chunk that ends
    so. Only the pieces of records at the edges of chunks are grouped.
    ``of_files``: a table by ``_path`` whose other columns come along; lines
    of files that it lacks go. It is joined to the table of chunks, not to lines.
    """
    counted = _chunked(lines)
    chunks = _chunk_parities(counted)
    more = []
    if of_files is not None:
        chunks, more = chunks.join(of_files, "_path"), [c for c in of_files.columns if c != "_path"]
    # Each line begins with its number within the chunk, by which they are sorted: fewer bytes than a struct of both.
    width = (CHUNK_BITS + 3) // 4 + 1
    placed_line = F.concat(F.lpad(F.hex(F.col("_number").bitwiseAND((1 << CHUNK_BITS) - 1)), width, "0"), "_line")
    packed = counted.groupBy(*_CHUNK).agg(F.collect_list(placed_line).alias("_lines"))
    text = F.array_join(F.transform(F.sort_array("_lines"), lambda x: F.substring(x, width + 1, 1 << 30)), "\n").alias("_text")
    # Joined by the key of the packed lines, so that these are dealt once.
    known = packed.select(*_CHUNK, text).join(chunks, _CHUNK)
    starts, ends = F.col("_start") == 1, F.col("_end") == 1
    whole = F.concat(F.lit("\n"), F.when(starts, '"').otherwise(""), F.col("_text"), F.when(ends, '"').otherwise(""))
    records = F.when(F.col("_paired"), F.regexp_extract_all(whole, F.lit(_NEXT_RECORD), F.lit(1))).otherwise(F.split("_text", "\n", -1))
    # Counted before they are exploded, or each would be cut anew.
    kept = [*_CHUNK, "_number", "_start", "_end", "_owner", *more]
    counted_records = known.select(*kept, records.alias("_records")).select(*kept, "_records", F.size("_records").alias("_n"))
    cut = counted_records.select(*kept, "_n", F.posexplode("_records").alias("_at_record", "_line"))
    # Records that go on from or into another chunk, without the quote put there.
    goes_on = starts & (F.col("_at_record") == 0)
    is_open = ends & (F.col("_at_record") == F.col("_n") - 1)
    line = F.substring(F.col("_line"), F.when(goes_on, 2).otherwise(1), F.length("_line") - goes_on.cast("int") - is_open.cast("int"))
    placed = cut.select("_path", "_block", (F.col("_number") + F.col("_at_record")).alias("_number"), F.when(goes_on | is_open, line).otherwise(F.col("_line")).alias("_line"),
                        *more, (goes_on | is_open).alias("_part"), F.when(goes_on, F.col("_owner")).otherwise(F.struct("_block", "_chunk")).alias("_begun"))
    single = placed.filter(~F.col("_part")).select("_path", "_block", "_number", "_line", *more)
    first = F.get("_parts", F.lit(0))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_number", "_line"))).alias("_parts")
    several = placed.filter("_part").groupBy("_path", "_begun").agg(parts, *[F.first(c).alias(c) for c in more]).select(
        "_path", first["_block"].alias("_block"), first["_number"].alias("_number"), F.array_join("_parts._line", "\n").alias("_line"), *more)
    return single.unionByName(several)


def _header_lines(lines: DataFrame, known: list[str]) -> DataFrame:
    """The header lines, split; only lines that pass the raw-text test are split."""
    candidates = lines.filter(header_candidate(F.col("_line"))).select("*", csv_fields("_line").alias("_f"))
    return candidates.filter(header_predicate(F.col("_f"), known))


def text_lines(text: DataFrame) -> DataFrame:
    """``(_path, _block, _number, _line)`` from a text-source frame (batch or streaming).

    Lines of one block are numbered in order within their task; blocks are
    ordered by their start.
    """
    return text.select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_number"), F.col("value").alias("_line"))


def text_files(text: DataFrame) -> DataFrame:
    """``(_path, _content)`` from a ``wholetext`` text-source frame (batch or streaming)."""
    return text.select(F.col("_metadata.file_path").alias("_path"), F.col("value").alias("_content"))


# Ids of chosen files that become a filter of the listing, at most; more are told apart by a join.
CHOSEN_IDS = 50_000


def chosen_ids(only: DataFrame, column: str = "station_id") -> list[str] | None:
    """The distinct values of a column of ``only``, or None if they are more than CHOSEN_IDS."""
    rows = only.select(column).filter(F.col(column).isNotNull()).distinct().limit(CHOSEN_IDS + 1).collect()
    return None if len(rows) > CHOSEN_IDS else [r[0] for r in rows]


def _one_of(column: str, values: list[str]) -> Column:
    """``column IN (values)`` as one expression, as thousands of literals one by one are slow to make."""
    if not values:
        return F.lit(False)
    quoted = ("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"{column} IN ({', '.join(quoted)})")


def chosen_files(text: DataFrame, only: DataFrame, ids: list[str] | None, folder: str | None = None,
                 id_pattern: str = STEM_PATTERN) -> DataFrame:
    """``text`` (a text-source frame) of the files of the stations of ``only``; ``ids`` is ``chosen_ids(only)``.

    With ids and either folders named by them (``folder=<id>``) or files named
    ``<id>.csv`` the choice is a filter on the partition column or the file's name:
    files left out are dropped from the listing and never opened. Otherwise the
    choice is a semi join: on the partition column, where Spark may prune
    folders at run time, or on the id in the path, after a file was opened.
    """
    if folder is not None and ids is not None:
        return text.filter(_one_of(f"`{folder}`", ids))
    if ids is not None and id_pattern == STEM_PATTERN:
        return text.filter(_one_of("_metadata.file_name", [f"{i}.csv" for i in ids]))
    key = F.col(f"`{folder}`") if folder is not None else F.regexp_extract("_metadata.file_path", id_pattern, 1)
    return _joined_to(text, key, only.select(F.col("station_id").alias("_id")))


def _joined_to(text: DataFrame, key: Column, chosen: DataFrame) -> DataFrame:
    # The key is made before the join: both sides may be file scans with a ``_metadata`` of their own.
    files = text.select("*", "_metadata", key.alias("_file"))
    return files.join(chosen.distinct(), F.col("_file") == F.col("_id"), "left_semi").drop("_file")


def chosen_paths(text: DataFrame, only_paths: DataFrame, paths: list[str] | None) -> DataFrame:
    """``text`` of the files whose ``path`` is in ``only_paths``; ``paths`` is ``chosen_ids`` of that column."""
    if paths is not None:
        return text.filter(_one_of("_metadata.file_path", paths))
    return _joined_to(text, F.col("_metadata.file_path"), only_paths.select(F.col("path").alias("_id")))


def _text(spark: SparkSession, paths, file_pattern: str | None, recursive: bool, wholetext: bool,
          folder: str | None = None) -> DataFrame:
    reader = spark.read
    if folder is not None:
        reader = reader.schema(f"value string, `{folder}` string")  # ids stay text
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    if recursive and folder is None:  # with it Spark finds no partition columns
        reader = reader.option("recursiveFileLookup", True)
    # ``text`` sets ``wholetext`` itself (its argument overrides an option).
    return reader.text(paths, wholetext=wholetext)


def read_readings(spark: SparkSession, paths: str | list[str], schema: StructType = READINGS_SCHEMA,
                  header_marker: str = HEADER_MARKER, keep_path: bool = False,
                  flag_ragged: bool = False, whole_files: bool | None = None,
                  file_pattern: str | None = None, recursive: bool = False,
                  whole_file_bytes: int = WHOLE_FILE_BYTES, only: DataFrame | None = None,
                  id_pattern: str = STEM_PATTERN, folder: str | None = None,
                  quoted_breaks: bool = False, only_paths: DataFrame | None = None) -> DataFrame:
    """Read CSV files aligned by name to ``schema``.

    ``paths`` is a directory (with ``file_pattern`` such as ``"*.csv"`` and,
    for nested folders, ``recursive=True``), a path, a list or a glob. For
    many files prefer the directory with a pattern: the directory is listed
    once, whereas a glob or a list of paths is expanded and checked path by
    path on the driver (measured: 0.3 s against 40 s for 5,000 local files).

    Absent target columns are null; other columns are ignored; empty fields
    are null. ``keep_path`` adds ``source_file``; ``flag_ragged`` adds
    ``ragged`` (the line's field count differs from its header's).

    ``only``: a table with ``station_id``; other stations' files are left out. A
    file's id is its partition folder's value (``folder``, for ``<folder>=<id>/``)
    or what ``id_pattern`` takes from its path. The ids are looked up first (one
    job), so that only the chosen files are opened (``chosen_files``).
    ``only_paths``: the same by ``path``, as a listing gives it.

    ``quoted_breaks``: quoted fields may hold line breaks (see the module's text).

    ``whole_files=None`` (default) decides per file in one plan: files up to
    ``whole_file_bytes`` go through the whole-file mode, larger ones through
    the line mode, and the two are unioned. The split is a filter on
    ``_metadata.file_size``, which the file index applies while listing,
    so each branch opens only its own files (no extra listing job).
    ``True`` / ``False`` force one mode for all files.
    """
    ids = None if only is None else chosen_ids(only)
    wanted = None if only_paths is None else chosen_ids(only_paths, "path")

    def branch(whole: bool, size_filter) -> DataFrame:
        text = _text(spark, paths, file_pattern, recursive, whole, folder)
        if size_filter is not None:
            text = text.filter(size_filter)
        if only is not None:
            text = chosen_files(text, only, ids, folder, id_pattern)
        if only_paths is not None:
            text = chosen_paths(text, only_paths, wanted)
        rows = (text_files if whole else text_lines)(text)
        return (align_files if whole else align_lines)(rows, schema, header_marker, keep_path, flag_ragged, quoted_breaks)

    if whole_files is not None:
        return branch(whole_files, None)
    size = F.col("_metadata.file_size")
    return branch(True, size <= whole_file_bytes).unionByName(branch(False, size > whole_file_bytes))


def headerless_files(spark: SparkSession, paths: str | list[str], schema: StructType = READINGS_SCHEMA,
                     header_marker: str = HEADER_MARKER, file_pattern: str | None = None,
                     recursive: bool = False) -> DataFrame:
    """``source_file`` of every file in which no header is recognised (its lines are not read as data).

    Spark's file sources skip files of zero bytes; they are not reported.
    """
    known = [header_marker, *[f.name for f in schema.fields]]
    lines = text_lines(_text(spark, paths, file_pattern, recursive, wholetext=False))
    with_header = _header_lines(lines, known).select("_path").distinct()
    # The listing reads no content.
    listing = file_listing(spark, paths, file_pattern, recursive).select(F.col("path").alias("source_file"))
    return listing.join(with_header, F.col("source_file") == F.col("_path"), "left_anti")
