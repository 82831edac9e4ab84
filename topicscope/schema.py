"""Record layout of the news knowledge-graph files (GKG 2.x, tab separated)."""

from __future__ import annotations

from pyspark.sql import types as T

# The 27 columns of a record, in file order.  Column 1 is a
# date written as yyyyMMddHHmmss, column 2 an integer, the rest strings.
GKG_COLUMNS = (
    "GKGRECORDID", "DATE", "SourceCollectionIdentifier", "SourceCommonName",
    "DocumentIdentifier", "Counts", "V2Counts", "Themes", "V2Themes",
    "Locations", "V2Locations", "Persons", "V2Persons", "Organizations",
    "V2Organizations", "V2Tone", "Dates", "GCAM", "SharingImage",
    "RelatedImages", "SocialImageEmbeds", "SocialVideoEmbeds", "Quotations",
    "AllNames", "Amounts", "TranslationInfo", "Extras",
)

DATE_INDEX = 1
ALL_NAMES_INDEX = 23
GKG_DATE_FORMAT = "yyyyMMddHHmmss"
SEGMENT_MINUTES = 15
SEGMENT_EXTENSION = ".gkg.csv"
DEFAULT_LAST_KEY = "20150218230000-0"


def gkg_schema() -> T.StructType:
    """Declared schema; every field nullable, nothing inferred."""
    fields = []
    for i, name in enumerate(GKG_COLUMNS):
        if i == DATE_INDEX:
            dtype = T.DateType()
        elif i == 2:
            dtype = T.IntegerType()
        else:
            dtype = T.StringType()
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


RESULT_TYPE = "array<struct<topic:string,count:bigint>>"
RECORD_SCHEMA = "key string, value string, timestamp timestamp"
