"""Job settings. Small files, read once and held on the driver."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T


class ConfigError(ValueError):
    """A setting is missing, unreadable or contradicts itself."""


def read_text(spark: SparkSession, path: str) -> str:
    try:
        row = spark.read.text(path, wholetext=True).head()
    except Exception as e:
        raise ConfigError(f"cannot read {path}: {e}") from e
    return row.value if row else ""


def read_json(spark: SparkSession, path: str) -> dict:
    try:
        return json.loads(read_text(spark, path))
    except json.JSONDecodeError as e:
        raise ConfigError(f"{path} is not valid JSON: {e}") from e


def entry(config: dict, name: str):
    """One environment or record type of a config; unknown names are errors."""
    if name not in config:
        raise ConfigError(f"{name} is not configured; known: {', '.join(sorted(config))}")
    return config[name]


def clean_name(name: str) -> str:
    """A column name as histories hold it."""
    return name.strip().translate(str.maketrans({" ": "_", "-": "_", "(": None, ")": None})).lower()


# ---- schemas ---------------------------------------------------------------

# Type names a schema config may use. Dates stay text until the
# date step parses them.
SCHEMA_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.StringType(),
    "timestamp": T.TimestampType(),
}
DECIMAL_TYPE = r"decimal\((\d+),(\d+)\)"


def field_type(name: str) -> T.DataType:
    if name in SCHEMA_TYPES:
        return SCHEMA_TYPES[name]
    sizes = re.match(DECIMAL_TYPE, name)
    if sizes is None:
        raise ConfigError(f"unsupported type: {name}")
    return T.DecimalType(*map(int, sizes.groups()))


def schema_of(config: dict, rec_type: str) -> T.StructType:
    """StructType of one record type, from {type: {columns: [{name, type}]}}."""
    columns = entry(config, rec_type)["columns"]
    return T.StructType([T.StructField(c["name"], field_type(c["type"]), True) for c in columns])


# ---- rules -----------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One data-quality rule; `want` holds its length, value, list or type name."""

    kind: str
    column: str | None = None
    want: object = None

    @property
    def text(self) -> str:
        name = f'{self.kind} "{self.column}"' if self.column else self.kind
        if self.want is None:
            return name
        if isinstance(self.want, tuple):
            return f"{name} in [" + ", ".join(f'"{v}"' for v in self.want) + "]"
        return f"{name} = {self.want}" if isinstance(self.want, int) else f'{name} = "{self.want}"'


def column_count(n: int) -> Rule:
    return Rule("ColumnCount", None, n)


def values_eq(column: str, value: str) -> Rule:
    return Rule("ColumnValues", column, value)


def values_in(column: str, values) -> Rule:
    return Rule("ColumnValues", column, tuple(values))


def length_is(column: str, n: int) -> Rule:
    return Rule("ColumnLength", column, n)


def data_type(column: str, name: str) -> Rule:
    return Rule("ColumnDataType", column, name)


def is_unique(column: str) -> Rule:
    return Rule("IsUnique", column)


def is_complete(column: str) -> Rule:
    return Rule("IsComplete", column)


_NAME = r"""['"]([^'"]+)['"]"""
_RULE_SHAPES = [
    (r"ColumnCount\s*=\s*(\d+)", lambda g: column_count(int(g[0]))),
    (rf"ColumnValues\s+{_NAME}\s*=\s*{_NAME}", lambda g: values_eq(*g)),
    (rf"ColumnValues\s+{_NAME}\s+in\s*\[([^\]]*)\]", lambda g: values_in(g[0], re.findall(_NAME, g[1]))),
    (rf"ColumnLength\s+{_NAME}\s*=\s*(\d+)", lambda g: length_is(g[0], int(g[1]))),
    (rf"ColumnDataType\s+{_NAME}\s*=\s*{_NAME}", lambda g: data_type(*g)),
    (rf"IsUnique\s+{_NAME}", lambda g: is_unique(g[0])),
    (rf"IsComplete\s+{_NAME}", lambda g: is_complete(g[0])),
]


def type_key(config: dict, rec_type: str) -> str:
    """The name a config has for a record type, which may be spelled out; unknown types are errors."""
    for name in (rec_type, f"rec_type_{rec_type}", rec_type.removeprefix("rec_type_")):
        if name in config:
            return name
    raise ConfigError(f"{rec_type} is not configured; known: {', '.join(sorted(config))}")


def rules_of(config: dict, rec_type: str, required: bool = False) -> list[Rule]:
    """Rules of one type, from its bracketed list; a type without rules has none.

    With `required` a type that is not listed is an error, so that a misspelled one
    does not go unchecked; an empty list says that there are no rules.
    """
    name = type_key(config, rec_type) if required else rec_type
    text = config.get(name, "").strip().removeprefix("[").removesuffix("]")
    rules = []
    for item in filter(None, (t.strip() for t in re.split(r",(?![^\[]*\])", text))):
        found = [(re.fullmatch(shape, item), build) for shape, build in _RULE_SHAPES]
        hit = next(((m, build) for m, build in found if m), None)
        if hit is None:
            raise ConfigError(f"{rec_type}: not a known rule: {item}")
        rules.append(hit[1](hit[0].groups()))
    return rules


# ---- history and transpose ---------------------------------------------------


@dataclass(frozen=True)
class HistoryConfig:
    rec_type: str
    primary_keys: tuple[str, ...]
    batch_date: str
    joining_key: tuple[str, ...] = ()
    delete_indicator: str | None = None
    database: str = ""
    source_path: str = ""
    table_path: str = ""
    tie_breakers: tuple[str, ...] = field(default=())

    @property
    def join_on(self) -> tuple[str, ...]:
        return self.joining_key or self.primary_keys

    @staticmethod
    def of(config: dict, rec_type: str) -> "HistoryConfig":
        """From the settings of one type; column names are cleaned like the columns."""
        c = entry(config, rec_type)
        if not c.get("primary_keys") or not c.get("Batch_date"):
            raise ConfigError(f"{rec_type}: primary_keys and Batch_date are required")
        names = lambda v: tuple(clean_name(n) for n in ([v] if isinstance(v, str) and v else v or ()))
        return HistoryConfig(
            rec_type=rec_type,
            primary_keys=names(c["primary_keys"]),
            batch_date=clean_name(c["Batch_date"]),
            joining_key=names(c.get("joining_key")),
            delete_indicator=clean_name(c.get("Delete_indicator_column") or "") or None,
            database=c.get("database_name", ""),
            source_path=c.get("source_path", ""),
            table_path=c.get("hudi_table_path", "")  # key name fixed by existing configs,
        )


@dataclass(frozen=True)
class TransposeConfig:
    group_by: tuple[str, ...]
    pivot: str
    value: str
    select: tuple[str, ...] = ()
    pivot_values: tuple[str, ...] | None = None
    order_by: tuple[str, ...] = ()

    @staticmethod
    def of(config: dict, rec_type: str) -> "TransposeConfig":
        c = entry(config, rec_type)
        if len(c["pivot_cols"]) != 1 or len(c["agg_cols"]) != 1:
            raise ConfigError(f"{rec_type}: exactly one pivot and one value column")
        return TransposeConfig(
            group_by=tuple(c["group_by_cols"]),
            pivot=c["pivot_cols"][0],
            value=c["agg_cols"][0],
            select=tuple(c.get("select_cols", ())),
            pivot_values=tuple(c["pivot_values"]) if c.get("pivot_values") else None,
        )
