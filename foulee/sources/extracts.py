"""Raw extracts (HR, declared sports, activities): headers, types and surrogate ids.

The extracts are CSV (or anything that gives a frame of strings with the same headers).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee import schemas
from foulee.functions.numeric import number_or_null
from foulee.operators.lookup import keep_one
from foulee.session import staged

# Extract headers and the column each one becomes.
EMPLOYEE_HEADERS = {
    "ID salarié": "id_salarie",
    "Nom": "nom",
    "Prénom": "prenom",
    "Date de naissance": "date_naissance",
    "BU": "bu",
    "Date d'embauche": "date_embauche",
    "Salaire brut": "salaire_brut",
    "Type de contrat": "type_contrat",
    "Nombre de jours de CP": "nb_jours_cp",
    "Adresse du domicile": "adresse",
    "Moyen de déplacement": "moyen_deplacement",
}
DECLARED_SPORT_HEADERS = {"ID salarié": "id_salarie", "Pratique d'un sport": "sport"}
ACTIVITY_HEADERS = {
    "ID": "id",
    "ID salarié": "id_salarie",
    "Date de début": "date_debut",
    "Type": "type_sport",
    "Distance (m)": "distance_m",
    "Temps écoulé (s)": "temps_ecoule_s",
    "Date de fin": "date_fin",
    "Commentaire": "commentaire",
}

# Day, month, hour and minute may have one or two digits.
_TIMESTAMP_FORMAT = "d/M/yyyy H:m"

_ROW_BITS = 33  # monotonically_increasing_id(): partition number above, row number below


def _csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """CSV in the usual dialect: a quote inside a quoted value is doubled. A row that does not fit the
    header fails the job; it is never filled up with nulls."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("escape", '"').option("multiLine", multi_line).option("mode", "FAILFAST").csv(path)


def read_extract(spark: SparkSession, path: str, headers: Mapping[str, str], multi_line: bool = True) -> DataFrame:
    """A CSV extract as strings. The header of every file must match, or the read fails.

    Values may hold line breaks. That makes a file one task, so large extracts should come as many
    files; ``multi_line=False`` splits files, for extracts whose values never hold a break (one that
    does then fails the job). An empty value is null, quoted or not.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in headers])
    raw = _csv(spark, path, schema, multi_line)
    return raw.select(*[F.nullif(F.col(f"`{name}`"), F.lit("")).alias(name) for name in headers])


def write_extract(df: DataFrame, path: str) -> None:
    """Strings as CSV that ``read_extract`` reads back unchanged."""
    writer = df.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _strict_timestamp(text: Column) -> Column:
    """Parse, or fail the job on a value that is present but not a timestamp, under any ANSI mode."""
    parsed = F.to_timestamp_ntz(text, F.lit(_TIMESTAMP_FORMAT))
    complaint = F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp_ntz")
    return F.coalesce(parsed, F.when(text.isNotNull(), complaint))


def load_employees(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnsRenamed(EMPLOYEE_HEADERS)
    return schemas.conform(renamed, schemas.EMPLOYEES)


def load_declared_sports(raw: DataFrame) -> DataFrame:
    return schemas.conform(raw.withColumnsRenamed(DECLARED_SPORT_HEADERS), schemas.DECLARED_SPORTS)


def load_activities(raw: DataFrame) -> DataFrame:
    """Activities typed and without the source's id. A distance that is no number becomes null;
    a timestamp that cannot be parsed fails the job."""
    renamed = raw.withColumnsRenamed(ACTIVITY_HEADERS)
    return renamed.select(
        F.col("id_salarie").cast("long").alias("id_salarie"),
        "type_sport",
        number_or_null(F.col("distance_m")).alias("distance_m"),
        F.col("temps_ecoule_s").cast("long").alias("temps_ecoule_s"),
        _strict_timestamp(F.col("date_debut")).alias("date_debut"),
        _strict_timestamp(F.col("date_fin")).alias("date_fin"),
        "commentaire",
    )


def with_surrogate_id(
    df: DataFrame, order: Sequence[str], partitions: int | None = None, first: int | Callable[[int], int] = 1
) -> DataFrame:
    """Number the rows 1..n in ``order``, then by the remaining columns; equal rows in any order.

    ``first`` is the first number, or gives it for the number of rows (see ``sinks.ids``).

    A window without partitions would number everything in one task. Instead the rows are range
    partitioned and sorted (a running number breaks ties, so even a third of all rows being equal
    spreads over many ranges), staged once in the shared folder, and every partition is shifted by
    the size of the ones before it. Only those sizes, one per partition, go through a single task.
    Runs the job that stages.
    """
    spark = df.sparkSession
    keys = [*order, *[name for name in df.columns if name not in order], "_rang"]
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = staged(
        df.withColumn("_rang", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *[F.asc_nulls_first(k) for k in keys])
        .sortWithinPartitions(*[F.asc_nulls_first(k) for k in keys])
        .drop("_rang")
        .withColumn("_position", F.monotonically_increasing_id()),
        "numerotation",
    )
    part = F.shiftright("_position", _ROW_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_lignes"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_lignes").over(before), F.lit(0)).alias("_avant"))
    if callable(first):
        first = first(ordered.count())
    row = F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition
        .select(*df.columns, (F.col("_avant") + row + first).alias("id"))
    )


def reference_or_default(
    spark: SparkSession, path: str | None, schema: T.StructType, default: DataFrame
) -> DataFrame:
    """A reference table from CSV, or ``default`` when there is no file at ``path``.

    Only a missing path falls back; a file that is there but wrong fails. The result has one row
    per value of its first column.
    """
    if path is None:
        return default
    try:
        table = _csv(spark, path, schema, multi_line=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return default
    return keep_one(table, [schema[0].name])
