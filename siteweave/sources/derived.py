"""Guide records derived from the star-schema tables, by fixed arithmetic that any SQL engine repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.config import DIRECTIONS, RECORD_COLUMNS
from siteweave.functions.wind import as_wind, parse_conditions

# Wind prose and the directions it means.
PROSE = {
    "E": "E",
    "E-SE": "E,SE",
    "All": "N,NE,E,SE,S,SW,W,NW",
    "WSW-WNW": "W",
    "North East": "NE",
    "NW-SW": "SW,W,NW",
    "South to South East": "SE,S",
    "SE-NE": "NE,E,SE",
    "NW- WSW (best WNW)": "W,NW",
    "SW-S-SE": "SE,S,SW",
    "W-SSW, Thermic": "SW,W",
    "SSW to SSE": "S",
    "SSE": "SE,S",
    "SE, NE, W": "NE,SE,W",
    "Thermic": "",
    "soarable over 10 knots": "",
}

_GRADES = "||".join(f"case when (k*{j + 3}+{j})%5 in (1,2) then ';{d}:'||cast((k*{j + 3}+{j})%5 as string) else '' end" for j, d in enumerate(DIRECTIONS))


def base_sql(customer: str = "customer", part: str = "part", supplier: str = "supplier") -> str:
    """One row for each record, without arrays and maps; runs on Spark and DuckDB alike."""
    return f"""
    select b.*, provider||':'||id as rkey,
      case when provider<>'ansg' and slot%9=0 then 'landing' else 'launch' end as role,
      (-30000000 + (slot%200)*10000 + ((k*7919 + length(provider)*31)%41-20)*100)/1e6 as lat,
      (115000000 + cast(floor(slot/200) as bigint)*20000 + ((k*104729 + ascii(provider))%37-18)*100)/1e6 as lon,
      case when provider='ansg' then 'AU' when provider='dhv' then (case k%3 when 0 then 'DE' when 1 then 'AT' else 'CH' end)
        when k%11=0 then 'NZ' else (case slot%6 when 0 then 'AU' when 1 then 'DE' when 2 then 'AT' when 3 then 'CH' when 4 then 'FR' end) end as country,
      case when k%4=0 then null else cast((k*37)%3000 as double) end as altitude,
      case when k%29=0 then 'Closed until '||cast(k as string) end as closed,
      case when k%17=0 then 'Land on field '||cast(k as string) end as notes,
      provider='dhv' and k%23=0 as tow,
      'https://example.org/'||provider||'/'||id as url,
      case when provider='pge' and k%13<>0 then substr({_GRADES}, 2) when provider='pge' then '' end as grades,
      case when provider<>'pge' then cast(k%16 as int) end as prose
    from (
      select 'pge' as provider, cast(c_custkey as string) as id, c_custkey as k, c_custkey - case when c_custkey%10=1 then 1 else 0 end as slot,
        c_name as name, cast(c_custkey as string) as gid, c_custkey%50=3 as approximate_location from {customer}
      union all
      select 'dhv', cast(cast(floor(p_partkey/3) as bigint) as string)||'-'||replace(p_name,' ','-')||'-'||cast(p_partkey%3 as string), p_partkey,
        cast(floor(p_partkey/2) as bigint), p_name, cast(cast(floor(p_partkey/3) as bigint) as string), false from {part}
      union all
      select 'ansg', cast(cast(floor(s_suppkey/2) as bigint) as string)||'-'||cast(s_suppkey as string), s_suppkey, s_suppkey*2,
        s_name, cast(cast(floor(s_suppkey/2) as bigint) as string), s_suppkey%40=7 from {supplier}
    ) b"""


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "part", "supplier")}
    return spark.sql(base_sql("{customer}", "{part}", "{supplier}"), **tables)


def records(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Records of the library's schema (and k, slot if asked for)."""
    graded = F.when(F.coalesce("grades", F.lit("")) != "", F.transform_values(F.str_to_map("grades", F.lit(";"), F.lit(":")), lambda _, v: v.cast("int")))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    said = as_wind(parse_conditions(F.get(F.array(*map(F.lit, PROSE)), F.col("prose"))))
    df = base(spark, sf_dir).withColumn("wind", F.when(F.col("provider") == "pge", F.coalesce(graded, none)).otherwise(said))
    return df.withColumn("group_ids", F.array("gid")).withColumn("key", F.col("rkey")).select(*RECORD_COLUMNS, *extra)


def slot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, cluster_id: records of one role and slot, whatever their distance."""
    return base(spark, sf_dir).select(F.col("rkey").alias("key"), F.concat_ws(":", "role", F.col("slot").cast("string")).alias("cluster_id"))
