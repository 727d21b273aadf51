"""Column expressions for extract lines. All of them are JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a plain text strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
HEADER, FOOTER = "H", "T"
FIELD, PAIR = "|", "~"


def _inked(byte: Column) -> Column:
    """Whether the byte at an end of a text is a printable ASCII character, the common case, which one comparison tells."""
    return byte.between(F.lit(b"!"), F.lit(b"~"))


def _end(c: Column, position: int) -> Column:
    """The byte at a position; that of a character would have to be looked for from the start."""
    return F.substring(c.cast("binary"), position, 1)


def strip(c: Column) -> Column:
    """Without white space at either end; only texts that have some there are walked through."""
    blank = lambda end: F.instr(F.lit(WHITESPACE), end) > 0
    return (
        F.when(_inked(_end(c, 1)) & _inked(_end(c, -1)), c)
        .when(blank(F.left(c, F.lit(1))) | blank(F.right(c, F.lit(1))), F.btrim(c, F.lit(WHITESPACE)))
        .otherwise(c)
    )


def strip_left(c: Column) -> Column:
    return F.when(_inked(_end(c, 1)), c).otherwise(F.ltrim(c, F.lit(WHITESPACE)))


def fields(line: Column) -> Column:
    """Every field of a line, empty ones included."""
    return F.split(line, r"\|", -1)


def record_type(line: Column) -> Column:
    return F.substring_index(line, FIELD, 1)


def first_field(arr: Column) -> Column:
    return F.element_at(arr, 1)


def last_field(arr: Column) -> Column:
    return F.element_at(arr, -1)


def text_after_last(line: Column) -> Column:
    """The last field of a line, without splitting it."""
    return F.substring_index(line, FIELD, -1)


def whole_number(c: Column) -> Column:
    """Integer value of a text, null where it is not one.

    The shape is tested first: a cast that fails costs far more than one that does not.
    """
    return F.when(c.rlike(r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"), c.try_cast("bigint"))


def footer_pairs(line: Column) -> Column:
    """Footer line to array<struct<rec_type, declared, position, bad>>.

    A pair needs exactly one separator and a whole number behind it.
    """
    cells = fields(line)
    parts = F.slice(cells, F.lit(2), F.size(cells))

    def pair(text: Column, position: Column) -> Column:
        sides = F.split(text, PAIR, -1)
        count = F.when(F.size(sides) == 2, whole_number(F.get(sides, F.lit(1))))
        return F.struct(
            F.get(sides, F.lit(0)).alias("rec_type"),
            count.alias("declared"),
            position.alias("position"),
            F.when(count.isNull(), 1).otherwise(0).alias("bad"),
        )

    return F.transform(parts, pair)


def date_or_null(c: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date of a text in a layout, null where it is none.

    Eight digits are read as dashed text, which costs less than the layout's
    parser and far less where it fails.
    """
    if pattern != "yyyyMMdd":
        return F.try_to_date(c, pattern)
    dashed = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(c.rlike("^(?!0000)[0-9]{8}$"), dashed.try_cast("date"))


def batch_day(c: Column) -> Column:
    """A batch date held as a date, or as text in either of two layouts."""
    text = c.cast("string")
    dashed = F.contains(text, F.lit("-"))
    return F.when(dashed, F.try_to_date(text, "yyyy-MM-dd")).otherwise(date_or_null(text))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """Name of the folder a file lies in."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def url_bucket(url: Column) -> Column:
    return F.parse_url(url, F.lit("HOST"))


def url_key(url: Column) -> Column:
    return F.ltrim(F.parse_url(url, F.lit("PATH")), F.lit("/"))


def day_folder(ts: Column) -> Column:
    return F.concat(F.lit("dt="), F.date_format(ts, "yyyy-MM-dd"))


def hour_folder(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd/HH")


def arrival_message(key: Column, bucket: Column, ts: Column) -> Column:
    return F.concat(key, F.lit(" uploaded in "), bucket, F.lit(" at "), ts)
