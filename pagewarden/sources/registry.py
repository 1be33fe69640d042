"""The registry: a JSON array of programs, from a file of any size that Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import codes
from ..functions import vocab as V

REQUIRED = ("institutionName.canonicalName", "target.lessThan", "target.lessThanOrEqualTo", "target.greaterThanOrEqualTo", "target.greaterThan", "localGovernmentLink.uri", "area.areaCode", "basicInformation.psid", "tag.contentsCode")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Rows (idx, registry, error): each element's JSON as it was. A text that is no JSON or no array is one row with an error."""
    text = spark.read.text(path, wholetext=True).withColumn("v", F.try_parse_json("value"))
    kind = F.schema_of_variant("v")
    return rows_of(text.withColumn("broken", F.when(F.col("v").isNull(), "invalid_json").when(~kind.startswith("ARRAY"), "not_an_array")))


def rows_of(text: DataFrame) -> DataFrame:
    bad = text.where("broken IS NOT NULL").select(F.lit(0).alias("idx"), F.lit(None).cast("string").alias("registry"), F.col("broken").alias("error"))
    items = text.where("broken IS NULL").select(F.posexplode(F.expr("cast(v AS array<variant>)")).alias("idx", "item"))
    return items.select("idx", F.to_json("item").alias("registry"), F.lit(None).cast("string").alias("error")).unionByName(bad)


def parse(rows: DataFrame) -> DataFrame:
    """Programs of registry rows, with ``error`` for the first fault of a row (the row's place is in idx)."""
    r = rows.withColumn("r", F.from_json("registry", schema.REGISTRY))
    missing = F.array_compact(F.array(*[F.when(F.col(f"r.{c}").isNull(), F.lit(c)) for c in REQUIRED]))
    um, area = codes.um_from_psid(F.col("r.basicInformation.psid")), codes.split_area(F.col("r.area.areaCode"))
    months = lambda b: codes.total_months(F.col(f"r.target.{b}.targetAge"), F.col(f"r.target.{b}.targetAgeOfMonths"))
    top = F.col("r.target.lessThanOrEqualTo")
    return r.select(
        "idx", "registry", F.coalesce("error", F.when(F.size(missing) > 0, F.concat(F.lit("bad_record: "), F.array_join(missing, ", "))).when(um.isNull(), "bad_psid").when(area.isNull(), "bad_area")).alias("error"),
        F.col("r.basicInformation.psid").alias("psid"), um.alias("um"), area["code"].alias("area_code"), area["name"].alias("area_name"), F.col("r.institutionName.canonicalName").alias("canonical_name"), F.col("r.institutionName.shortName").alias("short_name"), F.col("r.localGovernmentLink.uri").alias("source_url"),
        codes.normalize_codes(F.col("r.tag.categoryCode")).alias("category_codes"), codes.normalize_codes(F.col("r.tag.targetCode")).alias("target_codes"), codes.normalize_codes(F.col("r.tag.contentsCode")).alias("content_codes"),
        codes.age_min_months(months("greaterThanOrEqualTo"), months("greaterThan")).alias("age_min_months"), codes.age_max_months(months("lessThan"), top["targetAge"], top["targetAgeOfMonths"]).alias("age_max_months"),
    )


def areas(programs: DataFrame) -> DataFrame:
    """Areas by code with the name seen first; the area above has the same first two digits and is a prefecture's."""
    own = programs.groupBy(F.col("area_code").alias("code")).agg(F.min_by("area_name", "idx").alias("name"))
    up = own.where(F.substring("code", 3, 3) == "000").groupBy(F.substring("code", 1, 2).alias("p")).agg(F.min("code").alias("parent"))
    out = own.join(up, F.substring("code", 1, 2) == F.col("p"), "left")
    return out.select("code", "name", F.when(F.col("parent") != F.col("code"), F.col("parent")).alias("parent_code"))


def unknown_tags(programs: DataFrame) -> DataFrame:
    """Codes that the vocabulary lacks: (idx, kind, code)."""
    parts = [programs.select("idx", F.lit(k).alias("kind"), F.explode(codes.unknown_codes(F.col(f"{k}_codes"), [c for c, _ in tags])).alias("code")) for k, tags in V.TAGS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
