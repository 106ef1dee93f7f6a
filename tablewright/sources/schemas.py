"""Named schemas of the clinical tables and of rate bands."""

from __future__ import annotations

from pyspark.sql import types as T


def doubles(names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.DoubleType()) for name in names.split()])


# The column names of the raw and of the cleaned clinical table, in file order.
RAW = doubles("""
    age sex painloc painexer relrest pncaden cp trestbps htn chol smoke cigs years fbs dm famhist
    restecg ekgmo ekgday ekgyr dig prop nitr pro diuretic proto thaldur thaltime met thalach thalrest
    tpeakbps tpeakbpd dummy trestbpd exang xhypo oldpeak slope rldv5 rldv5e ca restckm exerckm restef
    restwm exeref exerwm thal thalsev thalpul earlobe cmo cday cyr target
""")
CLEANED = doubles("""
    age sex painloc painexer cp trestbps smoke fbs prop nitr pro diuretic thaldur thalach exang
    oldpeak slope target
""")

FEATURES = T.StructType([*CLEANED, *doubles("trestbpsxthalach")])
MERGED = T.StructType([*FEATURES, *doubles("smoke_source1 smoke_source2")])

# Column roles of the statistical flow.
STATISTICAL_CATEGORICAL = "sex htn restecg dig nitr prop pro diuretic exang xhypo target".split()
STATISTICAL_NUMERICAL = """
    trestbps chol ekgmo ekgday ekgyr thaldur thalach thalrest tpeakbps tpeakbpd dummy trestbpd
    oldpeak cmo cday cyr
""".split()

BANDS = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("lo", T.DoubleType()),
    T.StructField("hi", T.DoubleType()),
    T.StructField("rate", T.DoubleType()),
])
