"""A query log derived from the ``part`` table: the workload of the registered queries.

The text is plain SQL that means the same in every engine. It covers brands that are present,
absent, appended, missing, of several tokens, or only part of a token; every encoding of
attribute lists; and product types of one and two tokens. ``{part}`` is filled in by ``str.format``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERY_LOG_SQL = """
select p_partkey as query_id,
  case when p_partkey % 13 = 0 then concat(br, 'x ', p_name)
       when p_partkey % 4 = 0 then p_name
       when p_partkey % 4 = 1 then concat(br, '  ', p_name)
       when p_partkey % 4 = 2 then concat(p_name, ', ', p_type, '!')
       else concat(upper(p_name), ' for ', br) end as query,
  case when p_partkey % 7 = 0 then null else br end as brand,
  case cast(floor(p_partkey / 4) as bigint) % 6
       when 0 then concat('["', w1, '","', p_type, '"]')
       when 1 then concat('[''', w1, ''', ''', p_type, ''']')
       when 2 then concat('{{"c":"', w1, '","t":"', p_type, '"}}')
       when 3 then concat(w1, ', ', p_type)
       when 4 then concat('[', w1, ']')
       else null end as attributes,
  case when p_partkey % 5 = 0 then p_name else w2 end as product_type,
  w1 as true_attr1, p_type as true_attr2
from (select p_partkey, p_name, p_type,
        split_part(p_name, ' ', 1) as w1, split_part(p_name, ' ', 2) as w2,
        case when p_partkey % 11 = 0 then concat(p_brand, ' ', p_type, ' Co') else p_brand end as br
      from {part}) as parts
"""


def query_log(spark: SparkSession, part: DataFrame) -> DataFrame:
    """Query log over a ``part`` table."""
    return spark.sql(QUERY_LOG_SQL, part=part)
