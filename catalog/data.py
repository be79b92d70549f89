"""Listing tables derived from ``orders`` and ``part``, as DataFrames.

``va`` and ``vb`` have the shapes of the two raw sources, ``vt`` labels pairs
of their ids. The same SQL text serves both engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.operators import schema, validate
from pairwright.functions.serialize import group_fingerprint
from pairwright.plans.storage import materialize

LISTINGS = """
base AS (SELECT k, vk, 1980 + vk % 30 AS y, concat(p_brand, 'x', CAST(CAST(floor(p_partkey / 200) AS BIGINT) AS STRING)) br, p_name nm, CAST(tp AS BIGINT) AS odo, np
 FROM (SELECT o_orderkey k, CASE WHEN o_orderkey % 41 = 0 AND o_orderkey > 0 THEN o_orderkey - 1 ELSE o_orderkey END vk, floor(o_totalprice / 4) tp,
   (SELECT count(*) FROM {part}) AS np FROM {orders}) o
 JOIN {part} ON p_partkey = o.vk % o.np),
va AS (SELECT k AS id,
  CASE WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN concat('SHORT', CAST(k AS STRING)) WHEN k % 31 = 0 THEN lpad(CAST(k AS STRING), 17, '0')
       WHEN k % 37 = 0 THEN concat('1HGCM8263', 'Z', 'A', lpad(CAST(vk AS STRING), 6, '0'))
       ELSE concat('1HGCM8263', substr('ABCDEFGHJKLMNPRSTVWXY123456789', CAST(y - 1979 AS INT), 1), 'A', lpad(CAST(vk AS STRING), 6, '0')) END AS VIN,
  CASE WHEN k % 53 = 0 THEN NULL ELSE replace(br, '#', '-') END AS manufacturer,
  CASE WHEN k % 4 = 0 THEN upper(nm) WHEN k % 4 = 1 THEN concat(nm, ' lx') ELSE nm END AS model,
  CASE WHEN k % 59 = 0 THEN NULL WHEN k % 11 = 0 THEN concat(CAST(y AS STRING), '.0') ELSE CAST(y AS STRING) END AS year,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 47 = 0 THEN chr(160) || CAST(odo AS STRING) || ' ' ELSE CAST(odo AS STRING) END AS odometer,
  CASE WHEN k % 19 = 0 THEN chr(9) || nullif(split_part('gas,diesel,hybrid,other,electric,', ',', CAST(floor(vk / 30) % 6 + 1 AS INT)), '') || chr(160) ELSE nullif(split_part('gas,diesel,hybrid,other,electric,', ',', CAST(floor(vk / 30) % 6 + 1 AS INT)), '') END AS fuel,
  nullif(split_part('automatic,manual,other,', ',', CAST(floor(vk / 180) % 4 + 1 AS INT)), '') AS transmission,
  nullif(split_part('SUV,truck,pickup,offroad,mini-van,other,', ',', CAST(vk % 7 + 1 AS INT)), '') AS type,
  nullif(split_part('4 cylinders,6 cylinders,8 cylinders,other,2 cylinders,', ',', CAST(vk % 6 + 1 AS INT)), '') AS cylinders,
  nullif(split_part('4wd,fwd,rwd,', ',', CAST(vk % 4 + 1 AS INT)), '') AS drive,
  nullif(split_part('white,Grey,custom,red,', ',', CAST(vk % 5 + 1 AS INT)), '') AS paint_color
  FROM base),
vb AS (SELECT k AS id,
  concat('1HGCM8263', substr('ABCDEFGHJKLMNPRSTVWXY123456789', CAST(y - 1979 AS INT), 1), 'A', lpad(CAST(vk AS STRING), 6, '0')) AS vin,
  CASE WHEN k % 51 = 0 THEN NULL ELSE replace(br, '#', ' ') END AS make_name,
  CASE WHEN k % 2 = 0 THEN nm ELSE concat(nm, ' ex') END AS model_name, CAST(y AS STRING) AS year,
  CASE WHEN k % 39 = 0 THEN NULL ELSE concat(CAST(odo + (k % 5) * 7000 AS STRING), '.0') END AS mileage,
  nullif(split_part('Gasoline,Biodiesel,Hybrid,Flex Fuel Vehicle,Propane,', ',', CAST(floor(vk / 30) % 6 + 1 AS INT)), '') AS fuel_type,
  nullif(split_part('A,M,CVT,Dual Clutch', ',', CAST(floor(vk / 180) % 4 + 1 AS INT)), '') AS transmission,
  nullif(split_part('SUV / Crossover,Pickup Truck,Pickup Truck,SUV / Crossover,Minivan,Sedan,', ',', CAST(vk % 7 + 1 AS INT)), '') AS body_type,
  nullif(split_part('I4,V6,V8,H6,I2,', ',', CAST(vk % 6 + 1 AS INT)), '') AS engine_cylinders,
  CASE WHEN k % 17 = 0 THEN chr(9) || 'AWD' || chr(9) ELSE nullif(split_part('AWD,4X2,RWD,FWD', ',', CAST(vk % 4 + 1 AS INT)), '') END AS wheel_system,
  nullif(split_part('Bright White,Dark Gray Metallic,Midnight Blue,Maroon,', ',', CAST(vk % 5 + 1 AS INT)), '') AS exterior_color
  FROM base),
vt AS (SELECT a.id AS a_id, b.id AS b_id, 1 AS match FROM va a JOIN vb b ON a.VIN = b.vin
 UNION ALL SELECT a.id, b.id, 0 FROM va a JOIN vb b ON a.id = b.id + 1 WHERE a.VIN IS NULL OR a.VIN <> b.vin
 UNION ALL SELECT a.id, b.id, 0 FROM va a JOIN (SELECT *, 3 * (SELECT max(np) FROM base) AS step FROM vb) b ON a.id = b.id + b.step WHERE a.VIN IS NULL OR a.VIN <> b.vin)"""



# Derived tables by session, folder and name.
_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


def pair_rid(a: str, b: str) -> Column:
    """A pair's row key: both ids as one text, of any size."""
    return F.concat(F.col(a).cast("string"), F.lit("-"), F.col(b).cast("string"))


class Data:
    """The derived tables at one scale, built when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table, written once in a session: queries start from a table, as they would from a source."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _WRITTEN:
            _WRITTEN[key] = materialize(build(), f"listings-{name}")
        return _WRITTEN[key]

    @cached_property
    def _base(self) -> DataFrame:
        """The rows that both listing tables are made of: orders meet their part once."""
        def build() -> DataFrame:
            orders, tasks = self.table("orders").select("o_orderkey", "o_totalprice"), self.spark.sparkContext.defaultParallelism
            if orders.rdd.getNumPartitions() < tasks:  # a small file would be the part of one task, here and in what is derived from it
                orders = orders.repartition(tasks)
            return self.spark.sql(f"WITH {LISTINGS} SELECT * FROM base", orders=orders, part=self.table("part"))
        return self._written("base", build)

    def _view(self, name: str) -> DataFrame:
        """A listing table, row by row from the base, and written as well: its texts are costly to make."""
        texts = {t.split(" ", 1)[0]: t for t in re.split(r",\s*(?=v[abt] AS \()", LISTINGS.strip())}
        return self._written(name, lambda: self.spark.sql(f"WITH base AS (SELECT * FROM {{base}}), {texts[name]} SELECT * FROM {name}", base=self._base))

    def _labels(self) -> DataFrame:
        """The rows of ``vt``: its two joins by a shifted id are one, in which each row of ``vb`` takes part under both ids."""
        a = self.raw_a.select(F.col("id").alias("a_id"), F.col("VIN").alias("_a_vin"))
        b = self.raw_b.select(F.col("id").alias("b_id"), F.col("vin").alias("_b_vin"))
        step = 3 * (self._base.agg(F.max("np")).first()[0] or 0)
        same = a.join(b, F.col("_a_vin") == F.col("_b_vin")).select("a_id", "b_id", F.lit(1).alias("match"))
        shifted = b.withColumn("_at", F.explode(F.array(F.col("b_id") + 1, F.col("b_id") + step)))
        other = a.join(shifted, F.col("a_id") == F.col("_at")).filter("_a_vin IS NULL OR _a_vin <> _b_vin")
        return same.unionByName(other.select("a_id", "b_id", F.lit(0).alias("match")))

    @cached_property
    def raw_a(self) -> DataFrame:
        return self._view("va")

    @cached_property
    def raw_b(self) -> DataFrame:
        return self._view("vb")

    @cached_property
    def label_ids(self) -> DataFrame:
        return self._written("vt", self._labels)

    @cached_property
    def aligned_a(self) -> DataFrame:
        return schema.align(self.raw_a, "vehicles", rid="id")

    @cached_property
    def aligned_b(self) -> DataFrame:
        return schema.align(self.raw_b, "used_cars", rid="id")

    @cached_property
    def marked_a(self) -> DataFrame:
        marked = validate.mark_duplicate_vins(validate.mark_invalid_vin(self.aligned_a))
        return marked.select(self.aligned_a.columns)

    @cached_property
    def a(self) -> DataFrame:
        return self._written("a", lambda: schema.normalize_numeric(schema.normalize_all(self.marked_a)))

    @cached_property
    def b(self) -> DataFrame:
        return schema.normalize_numeric(schema.normalize_all(self.aligned_b))

    def _label_pairs(self, a: DataFrame, b: DataFrame) -> DataFrame:
        side = lambda df, s: df.select(F.col("rid").alias(f"{s}_id"), *[F.col(f).alias(f"{s}_{f}") for f in schema.FIELDS])
        both = self.label_ids.select("a_id", "b_id", "match").join(side(a, "a"), "a_id").join(side(b, "b"), "b_id")
        return both.select(pair_rid("a_id", "b_id").alias("rid"), "a_id", "b_id", *schema.PAIR_KEY, "match")

    @cached_property
    def labelled(self) -> DataFrame:
        """rid, a_id, b_id, a_<field>…, b_<field>…, match."""
        return self._label_pairs(self.a, self.b)

    @cached_property
    def labelled_raw(self) -> DataFrame:
        """As labelled, before the numeric repair."""
        return self._label_pairs(schema.normalize_all(self.aligned_a), schema.normalize_all(self.aligned_b))

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @property
    def document_block(self):
        return group_fingerprint([F.col("lang"), F.col("source")])

    @cached_property
    def scored(self) -> DataFrame:
        """Scores and 0/1 labels of documents."""
        docs = self.documents.select("doc_id", ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("score"))
        return docs.join(self.table("labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
