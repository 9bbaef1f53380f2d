"""Type mappings from source dialects to Spark column types."""

from __future__ import annotations

import re

# Plain type names per dialect. Sized and nested types are handled below.
# Integers of any name hold 38 digits in Snowflake, so only a profile can narrow them.
SNOWFLAKE = {
    "FLOAT": "double", "FLOAT4": "double", "FLOAT8": "double", "DOUBLE": "double",
    "DOUBLE PRECISION": "double", "REAL": "double", "BOOLEAN": "boolean", "DATE": "date",
    "TIME": "string", "DATETIME": "timestamp_ntz", "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP_NTZ": "timestamp_ntz", "TIMESTAMP_TZ": "timestamp", "TIMESTAMP_LTZ": "timestamp",
    "VARIANT": "variant", "OBJECT": "variant", "ARRAY": "variant",
    "VARCHAR": "string", "CHAR": "string", "CHARACTER": "string", "NCHAR": "string",
    "NVARCHAR": "string", "STRING": "string", "TEXT": "string",
    "BINARY": "binary", "VARBINARY": "binary", "GEOGRAPHY": "string", "GEOMETRY": "string",
    "INT": "decimal(38,0)", "INTEGER": "decimal(38,0)", "BIGINT": "decimal(38,0)",
    "SMALLINT": "decimal(38,0)", "TINYINT": "decimal(38,0)", "BYTEINT": "decimal(38,0)",
}
BIGQUERY = {
    "STRING": "string", "BYTES": "binary", "INT64": "bigint", "INT": "bigint",
    "INTEGER": "bigint", "BIGINT": "bigint", "SMALLINT": "bigint", "TINYINT": "bigint",
    "BYTEINT": "bigint", "FLOAT64": "double", "BOOL": "boolean", "BOOLEAN": "boolean",
    "DATE": "date", "TIME": "string", "DATETIME": "timestamp_ntz",
    "TIMESTAMP": "timestamp", "GEOGRAPHY": "string", "INTERVAL": "bigint", "JSON": "variant",
}
POSTGRES = {
    "SERIAL": "int", "BIGSERIAL": "bigint", "SMALLSERIAL": "smallint", "SMALLINT": "smallint",
    "INT2": "smallint", "INTEGER": "int", "INT": "int", "INT4": "int", "BIGINT": "bigint",
    "INT8": "bigint", "REAL": "float", "FLOAT4": "float", "DOUBLE PRECISION": "double",
    "FLOAT8": "double", "BOOLEAN": "boolean", "BOOL": "boolean", "MONEY": "decimal(19,2)",
    "TEXT": "string", "CITEXT": "string", "VARCHAR": "string", "CHARACTER VARYING": "string",
    "CHAR": "string", "CHARACTER": "string", "BPCHAR": "string", "UUID": "string",
    "ENUM": "string", "INET": "string", "CIDR": "string", "DATE": "date", "TIME": "string",
    "TIME WITHOUT TIME ZONE": "string", "TIME WITH TIME ZONE": "string",
    "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITHOUT TIME ZONE": "timestamp_ntz",
    "TIMESTAMPTZ": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp",
    "INTERVAL": "bigint", "BYTEA": "binary", "JSONB": "variant", "JSON": "variant",
    "HSTORE": "map<string,string>",
}
COLUMNAR = {
    "UInt8": "smallint", "UInt16": "int", "UInt32": "bigint", "UInt64": "decimal(20,0)",
    "Int8": "tinyint", "Int16": "smallint", "Int32": "int", "Int64": "bigint",
    "Float32": "float", "Float64": "double", "Bool": "boolean", "String": "string",
    "UUID": "string", "IPv4": "string", "IPv6": "string", "Date": "date", "Date32": "date",
    "DateTime": "timestamp_ntz", "JSON": "variant", "Map": "map<string,string>",
}
DIALECTS = {
    "snowflake": SNOWFLAKE, "bigquery": BIGQUERY, "postgres": POSTGRES, "columnar": COLUMNAR,
}

DECIMAL_NAMES = {"NUMBER", "NUMERIC", "BIGNUMERIC", "DECIMAL", "DEC", "BIGDECIMAL"}
DECIMAL_DEFAULTS = {"snowflake": (38, 0), "bigquery": (38, 9), "postgres": (38, 9), "columnar": (38, 9)}
#: Decimals named by their width, with the digits they hold.
DECIMAL_DIGITS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38}


class UnsupportedType(ValueError):
    """The source type has no Spark counterpart."""


def _arguments(text: str) -> list[str]:
    """Parts of a list at its top-level commas; quotes and brackets of any kind nest."""
    parts, depth, quoted, start = [], 0, False, 0
    for i, c in enumerate(text):
        if c == "'":
            quoted = not quoted
        elif not quoted and c in "(<[":
            depth += 1
        elif not quoted and c in ")>]":
            depth -= 1
        elif not quoted and c == "," and depth == 0:
            parts.append(text[start:i].strip())
            start = i + 1
    return [*parts, text[start:].strip()] if text.strip() else []


def _field(dialect: str, text: str, number: int) -> str:
    """A member ``name type`` of a struct, or a bare type that gets its number as name."""
    named = re.fullmatch(r"([A-Za-z_]\w*|`[^`]+`|\"[^\"]+\")[\s:]+(.+)", text, re.DOTALL)
    if named:
        return f"`{named.group(1).strip('`').strip(chr(34))}`:{spark_type(dialect, named.group(2))}"
    return f"`_{number}`:{spark_type(dialect, text)}"


def _struct(dialect: str, members: list[str]) -> str:
    return f"struct<{','.join(_field(dialect, m, i) for i, m in enumerate(members, 1))}>"


def spark_type(dialect: str, source_type: str) -> str:
    """Spark type for a source type such as ``NUMBER(12,2)``, ``ARRAY<STRUCT<a INT64>>`` or
    ``Array(Nullable(String))``."""
    text = re.sub(r"\s+", " ", source_type.strip())
    if text.endswith("[]"):
        return f"array<{spark_type(dialect, text[:-2])}>"
    if dialect == "postgres":  # the precision stands inside the name
        text = re.sub(r"(?i)^(time(?:stamp)?) ?\(\d+\)( with.*)?$", r"\1\2", text)
    match = re.fullmatch(r"([A-Za-z_][\w ]*?) ?(?:\((.*)\)|<(.*)>)?", text, re.DOTALL)
    if not match:
        raise UnsupportedType(f"{dialect}: {source_type}")
    name, inside = match.group(1), match.group(2) or match.group(3) or ""
    own, upper = _arguments(inside), name.upper()
    if dialect == "columnar":
        found = _columnar(name, own)
        if found:
            return found
    elif own and upper == "ARRAY":
        return f"array<{spark_type(dialect, inside)}>"
    elif own and upper == "STRUCT":
        return _struct(dialect, own)
    if upper in DECIMAL_NAMES:
        return _decimal(dialect, own)
    plain = DIALECTS[dialect]
    found = plain.get(name) or plain.get(upper)
    if found is None:
        raise UnsupportedType(f"{dialect}: {source_type}")
    return found


def _columnar(name: str, own: list[str]) -> str | None:
    """Wrapped, nested and sized types of columnar engines."""
    if name in ("Nullable", "LowCardinality"):
        return spark_type("columnar", own[0])
    if name == "Array":
        return f"array<{spark_type('columnar', own[0])}>"
    if name == "Map" and own:
        return f"map<{spark_type('columnar', own[0])},{spark_type('columnar', own[1])}>"
    if name == "Tuple":
        return _struct("columnar", own)
    if name == "Nested":
        return f"array<{_struct('columnar', own)}>"
    if name in ("Enum", "Enum8", "Enum16", "FixedString"):
        return "string"
    if name == "DateTime64" or name == "DateTime" and own:
        return "timestamp"
    if name in DECIMAL_DIGITS:
        return f"decimal({DECIMAL_DIGITS[name]},{int(own[0])})"
    return None


def _decimal(dialect: str, sizes: list[str]) -> str:
    digits = [int(s) for s in sizes if s]
    precision, scale = {
        0: lambda: DECIMAL_DEFAULTS[dialect],
        1: lambda: (digits[0], 0),
        2: lambda: (digits[0], digits[1]),
    }[len(digits)]()
    if precision > 38:
        raise UnsupportedType(f"decimal({precision},{scale}) has more than 38 digits")
    if scale == 0:
        return integer_type(precision)
    return f"decimal({precision},{scale})"


def integer_type(digits: int) -> str:
    """Smallest integer type that holds every number of so many digits."""
    for limit, name in ((2, "tinyint"), (4, "smallint"), (9, "int"), (18, "bigint")):
        if digits <= limit:
            return name
    return f"decimal({digits},0)"
