"""Loading raw feed lines: rows that fail are set apart with a reason, all others are loaded."""

from __future__ import annotations

import io
import re

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.strict_json import MAX_ID, is_id, object_members, storable, strict_loads, texts_of
from weftline.plans.runtime import ship

COLUMNS = ("id", "date_updated", "serialized_data")
FIELD = r'(?:"(?:[^"]|"")*+"|[^",\r\n]*+)'
QUOTED_WELL = re.compile(rf"{FIELD}(?:,{FIELD})*+")
SCHEMA = pa.schema([("at", pa.int32()), ("id", pa.int64()), ("date_updated", pa.string()), ("body", pa.string()), ("cell", pa.string()), ("reason", pa.string())])


def check_body(body, ident: int) -> tuple[str, str] | None:
    """What is wrong with an envelope's body: the failing cell and the reason."""
    if not isinstance(body, dict):
        return "serialized_data", "serialized_data is not an object"
    if "forager_id" in body and not (is_id(body["forager_id"]) and body["forager_id"] == ident):
        return "forager_id", "forager_id is not an integer equal to id"
    return None


def load_json_line(line: str) -> tuple:
    """(id, date_updated, body, cell, reason) of one envelope line; the body as it was delivered."""
    try:
        envelope = object_members(line)
    except ValueError:
        return None, None, None, "line", "malformed JSON"
    if envelope is None:
        return None, None, None, "line", "not a JSON object"
    ident, _ = envelope.get("id", (None, ""))
    if not is_id(ident):
        return None, None, None, "id", "id is not an integer from 0 to 2^63-1"
    body, text = envelope.get("serialized_data", (None, ""))
    wrong = check_body(body, ident)
    if wrong:
        return None, None, None, *wrong
    date, _ = envelope.get("date_updated", (None, ""))
    return ident, storable(date) if isinstance(date, str) else None, text, None, None


def load_csv_lines(lines: list[tuple[int, str]]) -> list[tuple]:
    """(at, id, date_updated, body, cell, reason) of CSV lines given with their place in the batch.

    A line with broken quoting could swallow its neighbours, so those are set apart first. The rest is parsed at once:
    the parser calls back for each row with a wrong number of columns. All columns are read as strings; the vector of
    ids is checked and cast, then the bodies, and each failing cell is labelled.
    """
    out, good = [], []
    for at, line in lines:
        line = line.removesuffix("\r\n").removesuffix("\n").removesuffix("\r")
        if QUOTED_WELL.fullmatch(line):
            good.append((at, line))
        else:
            out.append((at, None, None, None, "line", "broken quoting"))
    if not good:
        return out
    bad_rows: dict[int, int] = {}

    def refuse(row) -> str:
        bad_rows[row.number] = row.actual_columns
        return "skip"

    table = pacsv.read_csv(
        io.BytesIO("\n".join(line for _, line in good).encode("utf-8", "replace") + b"\n"),
        read_options=pacsv.ReadOptions(column_names=list(COLUMNS), use_threads=False, block_size=1 << 30),
        parse_options=pacsv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False, invalid_row_handler=refuse),
        convert_options=pacsv.ConvertOptions(column_types={c: pa.string() for c in COLUMNS}, strings_can_be_null=False, check_utf8=False),
    )
    first = 1  # the parser numbers rows from 1
    kept = [at for i, (at, _) in enumerate(good, first) if i not in bad_rows]
    if len(kept) != table.num_rows:
        raise AssertionError("the CSV parser and the quoting rule disagree on the number of rows")
    out += [(at, None, None, None, "line", f"{bad_rows[i]} columns instead of {len(COLUMNS)}") for i, (at, _) in enumerate(good, first) if i in bad_rows]
    ids = table.column("id").combine_chunks()
    digits = pc.utf8_ltrim(ids, "0")
    small = pc.or_(pc.less(pc.utf8_length(digits), 19), pc.and_(pc.equal(pc.utf8_length(digits), 19), pc.less_equal(digits, str(MAX_ID))))
    fits = pc.and_(pc.match_substring_regex(ids, r"\A[0-9]+\z"), small)
    cast = pc.cast(pc.if_else(fits, ids, None), pa.int64()).to_pylist()
    for at, ident, date, body in zip(kept, cast, table.column("date_updated").to_pylist(), table.column("serialized_data").to_pylist()):
        if ident is None:
            out.append((at, None, None, None, "id", "id is not made of digits up to 2^63-1"))
            continue
        try:
            wrong = check_body(strict_loads(body), ident)
        except ValueError:
            wrong = "serialized_data", "serialized_data is malformed JSON"
        out.append((at, None, None, None, *wrong) if wrong else (at, ident, date, body, None, None))
    return out


def load_lines(feed: DataFrame, *, file_col: str = "feed_file", line_col: str = "line_no", text_col: str = "raw_line") -> DataFrame:
    """(file, line, id, date_updated, body, cell, reason): a row for each line; reason is null for those that load.

    `.csv` files have the columns id, date_updated, serialized_data; all others are read as one JSON envelope a line. A
    null or blank line fails, as does one that isn't UTF-8; a null file name counts as JSON. Repeated lines are loaded each. Other columns are not
    read; an empty table gives no rows.
    """
    ship(feed.sparkSession)
    rows = feed.select(F.col(file_col).alias("file"), F.col(line_col).alias("line"), F.col(text_col).cast("string").alias("text"))

    def load(batches):
        for batch in batches:
            out, csv_lines = [], []
            for at, (file, text) in enumerate(zip(batch.column(0).to_pylist(), texts_of(batch.column(2)))):
                if isinstance(text, bytes):
                    out.append((at, None, None, None, "line", "not UTF-8"))
                elif text is None or not text.strip(" \t\r\n"):
                    out.append((at, None, None, None, "line", "empty line"))
                elif file is not None and file.endswith(".csv"):
                    csv_lines.append((at, text))
                else:
                    out.append((at, *load_json_line(text)))
            out += load_csv_lines(csv_lines)
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), SCHEMA.types)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(columns[0]), batch.column(1).take(columns[0]), *columns[1:]], names=["file", "line", *SCHEMA.names[1:]])

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    loaded = rows.mapInArrow(load, f"file {types['file']}, line {types['line']}, id long, date_updated string, body string, cell string, reason string")
    return loaded.withColumnsRenamed({"file": file_col, "line": line_col})
