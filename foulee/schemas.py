"""Table contracts. Sources are read against these types; nothing is inferred.

Activity times are wall-clock times, hence ``TimestampNTZType``: they mean the same in every
session time zone.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


EMPLOYEES = _struct(
    id_salarie=T.LongType(),
    nom=T.StringType(),
    prenom=T.StringType(),
    date_naissance=T.DateType(),
    bu=T.StringType(),
    date_embauche=T.DateType(),
    salaire_brut=MONEY,
    type_contrat=T.StringType(),
    nb_jours_cp=T.LongType(),
    adresse=T.StringType(),
    moyen_deplacement=T.StringType(),
)

ACTIVITIES = _struct(
    id_salarie=T.LongType(),
    type_sport=T.StringType(),
    distance_m=T.DoubleType(),
    temps_ecoule_s=T.LongType(),
    date_debut=T.TimestampNTZType(),
    date_fin=T.TimestampNTZType(),
    commentaire=T.StringType(),
    id=T.LongType(),
)

DECLARED_SPORTS = _struct(id_salarie=T.LongType(), sport=T.StringType())

SPORT_REFERENCE = _struct(type_sport=T.StringType(), duree_min_s=T.LongType(), categorie=T.StringType())

BUSINESS_UNITS = _struct(bu=T.StringType())

GEOCODES = _struct(adresse=T.StringType(), lat=T.DoubleType(), lon=T.DoubleType())

BENEFITS = _struct(
    id_salarie=T.LongType(),
    prime_sportive=T.BooleanType(),
    montant_prime=T.DoubleType(),
    jours_bienetre=T.IntegerType(),
    nb_activites=T.LongType(),
    date_calcul=T.DateType(),
)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select and cast exactly the columns of ``contract``; a value that does not fit fails the job."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract])
