"""Table contracts from the CREATE TABLE statements of a text file.

Columns keep their type, NOT NULL, length and whether the database fills them in; tables their primary key and references. What
only says how a database stores a table is passed over. Other statements of the file are passed over too.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from starlog.schemas import Contract

# Type names of CREATE TABLE statements (fixed values).
TYPES = {
    "smallint": T.ShortType(), "int2": T.ShortType(),
    "int": T.IntegerType(), "integer": T.IntegerType(), "int4": T.IntegerType(), "serial": T.IntegerType(),
    "bigint": T.LongType(), "int8": T.LongType(), "bigserial": T.LongType(),
    "real": T.FloatType(), "float4": T.FloatType(),
    "float": T.DoubleType(), "float8": T.DoubleType(), "double precision": T.DoubleType(),
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(), "timestamptz": T.TimestampType(),
    "text": T.StringType(), "char": T.StringType(), "varchar": T.StringType(), "character": T.StringType(),
    "character varying": T.StringType(), "nvarchar": T.StringType(), "bpchar": T.StringType(),
}
NAME = r'(?:"[^"]+"|\w+)'
TABLE = re.compile(rf"\s*create\s+(?:temp\w*\s+)?table\s+(?:if\s+not\s+exists\s+)?(?:{NAME}\.)?({NAME})\s*\(", re.I)
COLUMN = re.compile(rf"({NAME})\s+(double\s+precision|character\s+varying|\w+)\s*(?:\(\s*(\d+|max)\s*(?:,\s*(\d+)\s*)?\))?(.*)", re.I | re.S)
KEY = re.compile(rf"(?:constraint\s+{NAME}\s+)?primary\s+key\s*\(([^)]*)\)", re.I)
REFERENCE = re.compile(rf"(?:constraint\s+{NAME}\s+)?foreign\s+key\s*\(\s*({NAME})\s*\)\s*references\s+(?:{NAME}\.)?({NAME})", re.I)
COLUMN_REFERENCE = re.compile(rf"\breferences\s+(?:{NAME}\.)?({NAME})", re.I)
CLAUSE = re.compile(r"(constraint|primary\s+key|foreign\s+key|unique|check|like)\b", re.I)
ASIDE = re.compile(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/", re.S)  # quoted text and comments


def _plain(name: str) -> str:
    return name.strip().strip('"')


def _body(text: str) -> list[str]:
    """The clauses between the parenthesis that the text follows and the one that closes it."""
    depth, start, found = 0, 0, []
    for at, char in enumerate(text):
        if char == "(":
            depth += 1
        elif char == ")" and depth:
            depth -= 1
        elif char == ")" or (char == "," and not depth):
            found.append(text[start:at].strip())
            start = at + 1
            if char == ")":
                return found
    raise ValueError(f"a statement that does not end: {text[:60]}")


def _column(clause: str, key: tuple[str, ...]) -> T.StructField:
    parts = COLUMN.fullmatch(clause)
    if not parts:
        raise ValueError(f"not a column: {clause}")
    name, kind, size, scale, rest = parts.groups()
    kind = re.sub(r"\s+", " ", kind.lower())
    if kind in ("numeric", "decimal"):
        data_type = T.DecimalType(int(size or 18), int(scale or 0))
    elif kind in TYPES:
        data_type = TYPES[kind]
    else:
        raise ValueError(f"unknown type: {kind}")
    said = {}
    if isinstance(data_type, T.StringType) and size and size.lower() != "max":
        said["max_length"] = int(size)
    if kind.endswith("serial") or re.search(r"\b(identity|generated)\b", rest, re.I):
        said["generated"] = True
    required = _plain(name) in key or re.search(r"\bnot\s+null\b|\bprimary\s+key\b", rest, re.I) is not None
    return T.StructField(_plain(name), data_type, not required, said)


def contracts(text: str) -> dict[str, Contract]:
    """The contracts of the tables that the statements create, by name."""
    found = {}
    for statement in ASIDE.sub(" ", text).split(";"):
        begun = TABLE.match(statement)
        if not begun:
            continue
        clauses = _body(statement[begun.end() :])
        columns = [c for c in clauses if not CLAUSE.match(c)]
        keys = [tuple(_plain(n) for n in k[1].split(",")) for k in map(KEY.match, clauses) if k]
        keys += [(_plain(COLUMN.fullmatch(c)[1]),) for c in columns if re.search(r"\bprimary\s+key\b", c, re.I)]
        key = keys[0] if keys else ()
        references = {_plain(r[1]): _plain(r[2]) for r in map(REFERENCE.match, clauses) if r}
        for clause in columns:
            if told := COLUMN_REFERENCE.search(clause):
                references[_plain(COLUMN.fullmatch(clause)[1])] = _plain(told[1])
        name = _plain(begun[1])
        found[name] = Contract(name, T.StructType([_column(c, key) for c in columns]), key, references)
    return found


def read_contracts(spark: SparkSession, path: str) -> dict[str, Contract]:
    """The contracts of a file of statements."""
    return contracts(spark.read.text(path, wholetext=True).first()["value"])
