"""Norm-shaped tables derived row by row from the driver tables.

Every expression is plain SQL that Spark and DuckDB read alike, so a query and
its check see the same input and both grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.plans.registry import table, wide_table


def _text(expr: str) -> str:
    return f"cast({expr} as varchar(40))"


def _article(i: int) -> str:
    law = _text(f"10000 + (o_custkey * 7 + {i}) % 20000")
    return f"""concat('Artículo {i}.- ',
      case (o_custkey + {i}) % 5 when 0 then 'Derógase la ' when 1 then 'Modifica la ' when 2 then 'Según la '
        when 3 then 'Sustituida por la ' else 'Vista la ' end,
      'Ley N° ', {law}, ' y el Decreto Supremo N° 0', {_text(f"10 + (o_orderkey + {i}) % 80")}, '-2020-PCM en lo que corresponda.',
      case when (o_orderkey + {i}) % 3 = 0
        then concat(' (*) Artículo derogado por la Ley N° ', {_text(f"30000 + o_custkey % 500 + {i}")}, '.') else '' end)"""


_TEXT = "concat(" + ", ".join([
    "'EL CONGRESO'",
    "case o_orderkey % 10 when 0 then ' (*) DEROGADO por la Ley siguiente' when 1 then ' (*) (*)  DEJADA SIN EFECTO por norma' else '' end",
    f"chr(10), {_article(1)}",
    *[f"case when o_orderkey % 4 >= {i - 1} then concat(chr(10), {_article(i)}) else '' end" for i in (2, 3, 4)],
]) + ")"

NORM_COLUMNS = {
    "id": "o_orderkey",
    "type": """case substr(o_orderpriority, 1, 1) when '1' then 'CONSTITUCIÓN POLÍTICA' when '2' then 'LEY'
      when '3' then 'DECRETO SUPREMO' when '4' then 'RESOLUCIÓN MINISTERIAL' else 'COMUNICADO' end""",
    "number": f"concat(lpad({_text('o_orderkey % 1000')}, 3, '0'), '-', {_text('year(o_orderdate)')})",
    "title": f"""concat('Norma sobre ', case o_custkey % 6 when 0 then 'protección de la maternidad' when 1 then 'el contrato de trabajo temporal'
      when 2 then 'el medio ambiente' when 3 then 'el Código Civil' when 4 then 'la contratación pública' else 'la educación básica' end,
      ' de la entidad ', {_text('o_custkey % 97')})""",
    "date": "cast(o_orderdate as date)",
    "source": f"concat('SECTOR ', {_text('o_custkey % 20')})",
    "url": f"concat('https://example.org/#/detallenorma/H', {_text('o_orderkey')})",
    "is_valid": "case o_orderstatus when 'O' then 1 when 'F' then 0 end",
    "customer": "o_custkey",
    "updated": "o_orderdate",
    "raw_text": _TEXT,
}
NORMS_SQL = "select " + ",\n ".join(f'{e} as "{n}"' for n, e in NORM_COLUMNS.items()) + " from orders"


def norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_table(spark, sf_dir, "orders").selectExpr(*[f"{e} as `{n}`" for n, e in NORM_COLUMNS.items()])


ARTICLES_SQL = "select " + """n.id, i.i as "order", trim(string_split(n.raw_text, chr(10))[i.i + 1]) as content
 from norms n, (select unnest(range(1, 5)) as i) i where i.i <= n.id % 4 + 1"""


# Codes: published text of one line, as the second splitter sees it.
def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norms(spark, sf_dir).selectExpr("concat('C', cast(id as string)) as code_id", "title as code_name", "replace(raw_text, chr(10), ' ') as text", "id")


CODE_BLOCKS_SQL = f"""norms as ({NORMS_SQL}), arts as ({ARTICLES_SQL}),
 blocks as (select concat('C', cast(a.id as varchar)) as code_id, n.title as code_name, a.id, cast(a."order" as varchar) as article_num, a."order",
   a.content as block from arts a join norms n on n.id = a.id where length(a.content) >= 40)"""


# A stream of items: one link per user, the payload is the text.
ITEM_COLUMNS = {
    "url": f"concat('https://example.org/#/detallenorma/U', {_text('user_id * 20')})",
    "seq": "event_id",
    "type": "event_type",
    "number": f"{_text('user_id')}",
    "title": "concat('evento ', event_type)",
    "date": "cast(ts as date)",
    "source": "cast(null as varchar(10))",
    "status": "case when event_type = 'error' then 'DEROGADA: error' else 'VIGENTE' end",
    "is_valid": "case when event_type = 'error' then 0 else 1 end",
    "level": "5",
    "raw_text": "concat('Artículo 1.- Modifica la Ley N° ', regexp_extract(props, '([0-9]+)', 1), '.')",
}
ITEMS_SQL = "select " + ", ".join(f'{e} as "{n}"' for n, e in ITEM_COLUMNS.items()) + " from events"


def items(events: DataFrame) -> DataFrame:
    from lexmill.functions.text import content_hash

    shaped = events.selectExpr(*[f"{e} as `{n}`" for n, e in ITEM_COLUMNS.items()])
    return shaped.withColumn("text_hash", content_hash("raw_text"))


# Norms already stored before the items arrive.
STORED_COLUMNS = {
    "id": "c_custkey",
    "type": "c_mktsegment",
    "title": "c_name",
    "url": f"concat('https://example.org/#/detallenorma/U', {_text('c_custkey')})",
    "level": "4",
    "is_valid": "case when c_acctbal < 0 then 0 else 1 end",
    "old_text": f"concat('Artículo 1.- Modifica la Ley N° ', {_text('c_custkey % 100')}, '.')",
}
STORED_SQL = "select " + ", ".join(f'{e} as "{n}"' for n, e in STORED_COLUMNS.items()) + " from customer"


def stored_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from lexmill.functions.text import content_hash
    from lexmill.schemas import NORMS, conform

    rows = table(spark, sf_dir, "customer").selectExpr(*[f"{e} as `{n}`" for n, e in STORED_COLUMNS.items()])
    hashed = rows.withColumn("last_hash", content_hash("old_text")).withColumn("text_hash", F.col("last_hash"))
    return conform(hashed, NORMS)
