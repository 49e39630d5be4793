"""Schemas and fixed values of the documentation catalog.

Every table the library reads or writes has a declared StructType here, so
readers never infer a schema and missing JSON fields come back as nulls that
the operators coalesce to the catalog defaults.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values.  These must equal the documented behaviour of the help-text
# format and of the catalog being rebuilt; they are data, not logic.
# --------------------------------------------------------------------------

# Prefix of every class-body line in a help() dump: space, bar, two spaces.
HELP_PREFIX = " |  "
# A continuation line: bar followed by six spaces.
HELP_DOC_INDENT = " |      "
# Marks the end of the class docstring in a help() dump.
MRO_MARKER = "Method resolution order:"
# A line containing any of these starts a new section.
SECTION_HEADERS = (
    "Methods defined here:",
    "Static methods defined here:",
    "Data descriptors defined here:",
    "Data and other attributes defined here:",
    "Methods inherited from",
    "Data descriptors inherited from",
    "Class methods inherited from",
)

# Infrastructure methods that never count as "semantic" methods of a class.
BOILERPLATE_METHODS = (
    "GetClassName", "IsA", "IsTypeOf", "NewInstance", "SafeDownCast",
    "PrintSelf", "Register", "UnRegister", "FastDelete",
    "GetReferenceCount", "SetReferenceCount",
    "Modified", "GetMTime",
    "AddObserver", "RemoveObserver", "RemoveObservers",
    "HasObserver", "InvokeEvent", "GetCommand",
    "GetNumberOfGenerationsFromBase", "GetNumberOfGenerationsFromBaseType",
    "GetAddressAsString", "GetIsInMemkind", "GetUsingMemkind",
    "InitializeObjectBase", "SetMemkindDirectory", "UsesGarbageCollector",
    "GetObjectName", "SetObjectName", "GetObjectDescription",
    "override",
    "DebugOn", "DebugOff", "GetDebug", "SetDebug",
    "GlobalWarningDisplayOn", "GlobalWarningDisplayOff",
    "GetGlobalWarningDisplay", "SetGlobalWarningDisplay",
    "BreakOnError",
)

# Roles a class can be given.
ROLES = ("input", "filter", "properties", "renderer", "scene",
         "infrastructure", "output", "utility", "color")

# Label defaults and limits.
DEFAULT_VISIBILITY = 0.3
PAGE_DEFAULT_VISIBILITY = 0.0
MAX_DOC_CHARS = 2000
TRUNCATION_SUFFIX = "..."
KEY_METHODS_SHOWN = 20
NO_METHOD_DOC = "*No documentation available.*"
STAR = "⭐"
SEARCH_DEFAULT_LIMIT = 10

# Characters Python's str.strip() removes (str.isspace() is true for them),
# as a string for Spark's trim functions and as a regex class for DuckDB.
PY_WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
PY_WHITESPACE_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

SECTION = T.StructType([
    T.StructField("methods", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("method_count", T.IntegerType(), True),
])

STRUCTURED_DOCS = T.StructType([
    T.StructField("class_doc", T.StringType(), True),
    T.StructField("sections", T.MapType(T.StringType(), SECTION), True),
])

RECORD = T.StructType([
    T.StructField("class_name", T.StringType(), True),
    T.StructField("module_name", T.StringType(), True),
    T.StructField("class_doc", T.StringType(), True),
    T.StructField("structured_docs", STRUCTURED_DOCS, True),
    T.StructField("role", T.StringType(), True),
    T.StructField("input_datatype", T.StringType(), True),
    T.StructField("output_datatype", T.StringType(), True),
    T.StructField("semantic_methods", T.ArrayType(T.StringType()), True),
    T.StructField("synopsis", T.StringType(), True),
    T.StructField("action_phrase", T.StringType(), True),
    T.StructField("visibility_score", T.DoubleType(), True),
])

LABEL = T.StructType([
    T.StructField("class_name", T.StringType(), True),
    T.StructField("synopsis", T.StringType(), True),
    T.StructField("action_phrase", T.StringType(), True),
    T.StructField("visibility_score", T.DoubleType(), True),
])

HELP_DUMP = T.StructType([
    T.StructField("module_name", T.StringType(), True),
    T.StructField("class_name", T.StringType(), True),
    T.StructField("help_text", T.StringType(), True),
])

INVENTORY = T.StructType([
    T.StructField("module_name", T.StringType(), True),
    T.StructField("class_name", T.StringType(), True),
    T.StructField("is_class", T.BooleanType(), True),
])

CLASSES = T.StructType([
    T.StructField("class_name", T.StringType(), True),
    T.StructField("instantiable", T.BooleanType(), True),
    T.StructField("has_isa", T.BooleanType(), True),
    T.StructField("n_in", T.LongType(), True),
    T.StructField("n_out", T.LongType(), True),
])

CLASS_BASES = T.StructType([
    T.StructField("class_name", T.StringType(), True),
    T.StructField("base_name", T.StringType(), True),
])

PORTS = T.StructType([
    T.StructField("class_name", T.StringType(), True),
    T.StructField("direction", T.StringType(), True),
    T.StructField("port", T.IntegerType(), True),
    T.StructField("types", T.ArrayType(T.StringType()), True),
])

CLASS_METHODS = T.StructType([
    T.StructField("class_name", T.StringType(), True),
    T.StructField("method_name", T.StringType(), True),
    T.StructField("is_callable", T.BooleanType(), True),
])

STUBS = T.StructType([
    T.StructField("module_name", T.StringType(), True),
    T.StructField("content", T.StringType(), True),
])

STUB_LINES = T.StructType([
    T.StructField("module_name", T.StringType(), True),
    T.StructField("file", T.StringType(), True),
    T.StructField("block", T.LongType(), True),
    T.StructField("row", T.LongType(), True),
    T.StructField("line", T.StringType(), True),
    T.StructField("file_size", T.LongType(), True),
])
