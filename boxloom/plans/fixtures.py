"""Annotation-shaped views over the star-schema and text tables used for testing.

Each text is portable SQL: it runs unchanged in Spark and in the oracle database.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from boxloom import scale

VIEWS = {
    "detections": """
select cast(l_partkey as bigint) as image_id,
 case l_linenumber when 1 then 'eva-02-01' when 2 then 'co_detr' when 3 then 'eva-02-02' when 4 then 'ov_sam'
                   when 5 then 'owl_vit' when 6 then 'pomp' else 'grit' end as model,
 cast(l_linenumber as int) as priority,
 cast(row_number() over (partition by l_partkey, l_linenumber order by l_orderkey, l_suppkey, l_quantity,
   l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) as int) as seq,
 cast((cast(l_quantity as int) % 5) * 8 as double) as x1,
 cast((l_suppkey % 4) * 8 as double) as y1,
 cast((cast(l_quantity as int) % 5) * 8 + 40 + (l_orderkey % 3) * 4 as double) as x2,
 cast((l_suppkey % 4) * 8 + 40 + (l_orderkey % 2) * 4 as double) as y2,
 round(l_discount * 10, 2) as score,
 case when l_suppkey % 9 = 0 then 'person' else concat('class_', cast(l_suppkey % 6 as varchar(10))) end as label
from lineitem""",
    "images": """
select cast(p_partkey as bigint) as image_id, p_brand as dataset, p_type as class_name,
 concat(cast(p_partkey as varchar(20)), case when p_size % 3 = 0 then '.jpeg' when p_size % 3 = 1 then '.png' else '.jpg' end) as file_name,
 cast(64 + p_size as int) as width, cast(64 + (p_size % 7) * 8 as int) as height
from part""",
    "captions": """
select doc_id as image_id, 'llava' as source, trim(text) as caption from documents""",
    "responses": """
select conv_id as image_id, cast(turn as int) as attempt, text as response from conversations where role = 'assistant'""",
    "depth": """
select user_id as image_id, cast(event_id % 64 as int) as x, cast(cast(floor(event_id / 64) as int) % 64 as int) as y, value
from events where value is not null""",
}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SOURCE = {"detections": "lineitem", "images": "part", "captions": "documents", "responses": "conversations",
          "depth": "events"}


KEY = {"detections": "l_partkey"}       # the source's column that becomes image_id, of views that number rows
NUMBER = re.compile(r"row_number\(\) over \(.*?\)", re.DOTALL)


def view(spark: SparkSession, sf_dir: str, name: str, by_image: bool = False) -> DataFrame:
    """One of ``VIEWS`` as a DataFrame.

    Rows are numbered before the other columns are made, so a shuffle carries the source's columns only, the same for every use.
    ``by_image``: laid out by image for it, so that steps by image need no further shuffle (not where an image holds very many rows)."""
    source, sql = SOURCE[name], VIEWS[name]
    rows = table(spark, sf_dir, source)
    if name in KEY:
        rows = scale.laid_out(rows, KEY[name]) if by_image else rows
        rows = spark.sql(f"select *, {NUMBER.search(sql).group()} as _number from {{src}}", src=rows)
        sql = NUMBER.sub("_number", sql)
    return spark.sql(sql.replace(f"from {source}", "from {src}"), src=rows)


def with_views(names, sql: str) -> str:
    """``sql`` with the named views put before it as common table expressions."""
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in names)
    body = sql.strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
