"""Functions of the library under SQL names: value standardisation, and a table function for text lines.

    register(spark)
    SELECT std_plate(immat), std_number(amount) FROM raw
    SELECT * FROM rows_from_text(TABLE(lines) PARTITION BY doc ORDER BY (page, line_no))
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, Row, SparkSession
from pyspark.sql import functions as F

from waymill.functions import standardise as st
from waymill.operators.text_rows import Field

#: By SQL name, functions of one argument whose expressions have a SQL form (those with lambdas have none).
FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "std_text": st.text,
    "std_plate": st.plate,
    "std_vin": st.vin,
    "std_number": st.number,
    "std_phone": st.phone,
    "std_missing": st.is_missing,
}


def register_function(spark: SparkSession, name: str, use: Callable[[Column], Column], kind: str = "string") -> None:
    """A temporary SQL function of one argument whose body is the expression that ``use`` makes of it, so Spark plans it in place."""
    own = spark.createDataFrame([], f"arg {kind}").select(use(F.col("arg")).alias("out"))
    body = own._jdf.queryExecution().analyzed().expressions().head().child().sql()
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(arg {kind}) RETURNS {own.dtypes[0][1]} RETURN {body}")


def text_rows_function(doc: str, page: str, fields: list[Field], row: str) -> type:
    """A table function over lines (``doc``, ``page``, line_no, line) of one document in order: rows as ``text_rows.rows_from_lines`` gives them."""
    patterns = [(f, re.compile(f.pattern)) for f in fields]

    class RowsFromText:
        def __init__(self) -> None:
            self.page: object = None
            self.held: dict[str, str | None] = {}

        def eval(self, line: Row) -> Iterator[tuple]:
            if line[page] != self.page:
                self.page = line[page]
                self.held = {f.name: v for f, _ in patterns if f.carry == "doc" and (v := self.held.get(f.name)) is not None}
            here: dict[str, str | None] = {}
            for f, pattern in patterns:
                met = pattern.search(line["line"]) if line["line"] is not None else None
                value = (met.group(1) or "") if met else None
                if f.carry:
                    if value is not None and (f.overwrite != "preserve" or self.held.get(f.name) is None):
                        self.held[f.name] = value
                    value = self.held.get(f.name)
                here[f.name] = value
            if here[row] is not None:
                yield (line[doc], line[page], line["line_no"], *(here[f.name] for f, _ in patterns))

    return RowsFromText


def register_text_rows(spark: SparkSession, name: str, fields: list[Field], row: str, doc: str = "doc", page: str = "page", kinds: str = "doc string, page int, line_no int") -> None:
    """Registers ``text_rows_function`` under a SQL name, to be called with PARTITION BY the document ORDER BY (page, line_no)."""
    schema = f"{kinds}, " + ", ".join(f"`{f.name}` string" for f in fields)
    spark.udtf.register(name, F.udtf(text_rows_function(doc, page, fields, row), returnType=schema))


def register(spark: SparkSession) -> None:
    for name, use in FUNCTIONS.items():
        register_function(spark, name, use)
