"""Explicit schemas of the domain tables (no inference anywhere)."""

from pyspark.sql import types as T

_L, _I, _D, _S, _B, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BROKER_CLASSIFIER = _st(("classifier_id", _I), ("broker_name", _S), ("broker_version", _S),
                        ("classifier_name", _S), ("classifier_params", _S))
GENTYPE_OF_CLASSID = _st(("class_id", _I), ("gentype", _I), ("description", _S))
DIAOBJECT_TRUTH = _st(("dia_object_id", _L), ("gentype", _I), ("peakmjd", _D))
DIASOURCE = _st(("dia_source_id", _L), ("dia_object_id", _L), ("mid_point_tai", _D), ("ps_flux", _D),
                ("ps_flux_err", _D), ("filter_name", _S))
DIAFORCEDSOURCE = _st(("dia_object_id", _L), ("mid_point_tai", _D), ("ps_flux", _D), ("ps_flux_err", _D),
                      ("filter_name", _S))
DIAALERT = _st(("alert_id", _L), ("dia_source_id", _L), ("dia_object_id", _L), ("alert_sent_ts", _TS))
BROKER_MESSAGE = _st(("broker_message_id", _L), ("alert_id", _L), ("ingest_ts", _TS),
                     ("broker_ts", _TS))
BROKER_CLASSIFICATION = _st(("broker_message_id", _L), ("classifier_id", _I), ("class_id", _I),
                            ("probability", _D))
MESSAGE_PROBS = _st(("broker_message_id", _L), ("classifier_id", _I),
                    ("probs", T.ArrayType(_st(("class_id", _I), ("probability", _D)))))
MAXPROB_TIMEBINS = _st(("timebin", _I), ("dtmin", _D), ("dtmax", _D))
CONFUSION_CLASSES = _st(("true_class_id", _I), ("class_id", _I))

# JSON catalogue shapes (class and classifier catalogues keyed by id text).
CLASS_CATALOG_JSON = T.MapType(_S, T.StructType([
    T.StructField("exactmatch", _B), T.StructField("categorymatch", _B),
    T.StructField("broadmatch", _B), T.StructField("generalmatch", _B),
    T.StructField("description", _S), T.StructField("gentype", T.ArrayType(_I)),
]))
CLASSIFIER_CATALOG_JSON = T.MapType(_S, T.StructType([
    T.StructField("brokername", _S), T.StructField("brokerversion", _S),
    T.StructField("classifiername", _S), T.StructField("classifierparams", _S), T.StructField("nmessages", _L),
]))
# pandas "tight" dict: index rows, column names, data rows; cells as text, whatever their type.
TIGHT_FRAME_JSON = T.StructType([
    T.StructField("index", T.ArrayType(T.ArrayType(_S))),
    T.StructField("columns", T.ArrayType(_S)),
    T.StructField("data", T.ArrayType(T.ArrayType(_S))),
    T.StructField("index_names", T.ArrayType(_S)),
    T.StructField("column_names", T.ArrayType(_S)),
])
