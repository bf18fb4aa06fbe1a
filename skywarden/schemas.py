"""Explicit schemas of the engine's record types (nothing is inferred)."""

from pyspark.sql import types as T

S = T.StringType()

# Separators of the log formats.
RAW_SEP = "#CS#"
BLACKLIST_SEP = "|"

# Positional fields of a raw access line (M1), index = position.
RAW_FIELDS = [
    "localTime", "requestLine", "requestMethod", "contentType", "requestBody",
    "httpReferrer", "remoteAddr", "httpUserAgent", "timeIso8601", "serverAddr",
    "cookie", "activeConnections",
]

# Processed log (M10): 18 text fields in this order.
PROCESSED_FIELDS = [
    "requestMethod", "request", "remoteAddr", "httpUserAgent", "timeIso8601",
    "serverAddr", "highFrqIPGroup", "flightType", "behaviorType", "travelType",
    "flightDate", "depcity", "arrcity", "JSESSIONID", "USERID",
    "queryRequestDataStr", "bookRequestDataStr", "httpReferrer",
]
PROCESSED = T.StructType([T.StructField(f, S) for f in PROCESSED_FIELDS])

# Blacklist log.
BLACKLIST_FIELDS = ["remoteAddr", "flowID", "score", "ruleIDs", "ruleTime"]
BLACKLIST = T.StructType([T.StructField(f, S) for f in BLACKLIST_FIELDS])

# Enum names and ids (M6).
FLIGHT_TYPE_IDS = {"National": 0, "International": 1, "Other": -1}
BEHAVIOR_TYPE_IDS = {"Query": 0, "Book": 1, "Other": -1}
TRAVEL_TYPE_IDS = {"OneWay": 0, "RoundTrip": 1, "Unknown": -1}

# Query request data (M4): time, user and address fields are part of the
# record; no parser fills them.
QUERY_FIELDS = ["queryTime", "queryUserId", "queryUnUserId", "queryIp", "depCity", "arrCity", "flightDate",
                "adultNum", "childNum", "infantNum", "country"]
QUERY_RECORD = T.StructType([
    T.StructField("isEmpty", T.BooleanType()), T.StructField("flightType", T.IntegerType()),
    T.StructField("travelType", T.IntegerType()), *[T.StructField(f, S) for f in QUERY_FIELDS]])

# Booking request data (M5): scalars and string lists, in the order of the record.
BOOK_LISTS = ["psgName", "psgType", "idType", "idCard", "depCity", "arrCity", "flightDate", "flightNo", "cabin"]
BOOK_FIELDS = ["bookTime", "bookUserId", "bookUnUserId", "bookIp", "psgName", "psgType", "idType", "idCard",
               "contractName", "contractPhone", "bookAgent", "depCity", "arrCity", "flightDate", "flightNo", "cabin"]
BOOK_RECORD = T.StructType([
    T.StructField("flightType", T.IntegerType()), T.StructField("travelType", T.IntegerType()),
    *[T.StructField(f, T.ArrayType(S) if f in BOOK_LISTS else S) for f in BOOK_FIELDS]])
