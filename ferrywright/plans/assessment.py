"""Estimating the effort of a migration from a catalog of objects and a corpus of code."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrywright.scratch import checkpoint

# Weight of one object of each type, and the most that a type may count.
OBJECT_WEIGHTS = {
    "CLUSTER": 0, "FUNCTION": 1, "INDEX": 0.1, "FUNCTION-BASED-INDEX": 0.2, "REV-INDEX": 1, "CHECK": 0.1, "MATERIALIZED VIEW": 3, "PACKAGE BODY": 3, "PROCEDURE": 1, "SEQUENCE": 0.1, "TABLE": 0.1, "TABLE PARTITION": 0.1,
    "TABLE SUBPARTITION": 0.2, "TRIGGER": 1, "TYPE": 1, "TYPE BODY": 10, "VIEW": 1, "DATABASE LINK": 3, "GLOBAL TEMPORARY TABLE": 10, "DIMENSION": 0, "JOB": 2, "SYNONYM": 0.1, "QUERY": 0.2, "ENCRYPTED COLUMN": 20,
}
OBJECT_CAPS = {"INDEX": 288, "SEQUENCE": 288, "TABLE": 672, "TABLE PARTITION": 480, "TABLE SUBPARTITION": 480, "GLOBAL TEMPORARY TABLE": 288, "SYNONYM": 192}
# Cost of testing a piece of code, characters of one unit of reading, minutes of a unit, hours of a day.
TEST_COST = 2.0
SIZE_UNIT = {"oracle": 1000, "mysql": 1000, "tsql": 400}
UNIT_MINUTES, DAY_HOURS, HUMAN_DAYS_LIMIT = 5, 8, 5
#: Types whose code has no cost of testing and of reading.
UNTESTED = ("QUERY", "VIEW")

# What counts as a difficulty (keyword, weight, pattern; a negative weight takes back what another
# pattern has counted). Patterns are read without case and with a dot for line breaks too.
ORACLE_RULES = [
    ("IS TABLE OF", 4, r"\bIS\s+TABLE\s+OF\b"), ("OUTER JOIN", 2, r"\(\+\)"), ("CONNECT BY", 3, r"\bCONNECT\s+BY\b"), ("BULK COLLECT", 5, r"\bBULK\s+COLLECT\b"), ("FORALL", 1, r"\bFORALL\b"), ("GOTO", 2, r"\bGOTO\b"), ("ROWNUM", 1, r"\bROWNUM\b"),
    ("NOTFOUND", 0, r"\bNOTFOUND\b"), ("ROWID", 2, r"\bROWID\b"), ("UROWID", 2, r"\bUROWID\b"), ("SQLCODE", 1, r"\bSQLSTATE\b"), ("IS RECORD", 1, r"\bIS RECORD\b"), ("TABLE", 2, r"FROM[^;]*\bTABLE\s*\("), ("PIPE ROW", 1, r"PIPE\s+ROW"),
    ("DBMS_", 3, r"DBMS_\w"), ("DBMS_", -3, r"DBMS_STANDARD\.RAISE EXCEPTION"), ("UTL_", 3, r"UTL_\w"), ("CTX_", 3, r"CTX_\w"), ("EXTRACT", 3, r"\bEXTRACT\s*\("), ("TO_NUMBER", 0.1, r"\bTO_NUMBER\s*\("),
    ("EXCEPTION", 2, r"\b(DUP_VAL_ON_INDEX|TIMEOUT_ON_RESOURCE|TRANSACTION_BACKED_OUT|NOT_LOGGED_ON|LOGIN_DENIED|INVALID_NUMBER|PROGRAM_ERROR|VALUE_ERROR|ROWTYPE_MISMATCH|CURSOR_ALREADY_OPEN|ACCESS_INTO_NULL|COLLECTION_IS_NULL)\b"),
    ("PLUNIT", 2, "PLUNIT"), ("HTP", 0.2, r"\bHT[PF]\."), ("ADD_MONTHS", 0.1, "ADD_MONTHS"), ("LAST_DAY", 1, "LAST_DAY"), ("NEXT_DAY", 1, "NEXT_DAY"), ("MONTHS_BETWEEN", 1, "MONTHS_BETWEEN"), ("DBMS_OUTPUT.put", 1, r"DBMS_OUTPUT\.put\("),
    ("DBMS_", -3, r"DBMS_OUTPUT\.(put_line|new_line|put)"), ("TRUNC", 0.1, r"\bTRUNC\s*\("), ("REGEXP_LIKE", 0.1, "REGEXP_LIKE"), ("REGEXP_SUBSTR", 1, "REGEXP_SUBSTR"), ("REGEXP_COUNT", 0.2, "REGEXP_COUNT"), ("REGEXP_INSTR", 1, "REGEXP_INSTR"),
    ("PLVDATE", 2, "PLVDATE"), ("PLVSTR", 2, "PLVSTR"), ("PLVCHR", 2, "PLVCHR"), ("PLVSUBST", 2, "PLVSUBST"), ("PLVLEX", 2, "PLVLEX"), ("TG_OP", 0, r"\b(INSERTING|DELETING|UPDATING)\b"), ("CURSOR", 1, r"REF\s*CURSOR"), ("ORA_ROWSCN", 3, "ORA_ROWSCN"),
    ("SAVEPOINT", 1, "SAVEPOINT"), ("DBLINK", 1, r"(FROM|EXEC)((?!WHERE).)*\b[\w_]+@[\w_]+\b"), ("ISOPEN", 1, r"%ISOPEN\b"), ("ROWCOUNT", 1, r"%ROWCOUNT\b"), ("SDO_", 3, r"SDO_\w"), ("PRAGMA", 3, r"PRAGMA(?!\s+(?:RESTRICT_REFERENCES|SERIALLY_REUSABLE|INLINE))"),
    ("MDSYS", 1, r"MDSYS\.(?!\"*SDO_)"), ("MERGE INTO", 3, r"MERGE\sINTO"), ("CONTAINS", 1, r"\bCONTAINS\("), ("SCORE", 1, r"\bSCORE\((?:.*)?\bCONTAINS\("), ("FUZZY", 1, r"CONTAINS\((?:.*)?\bFUZZY\("), ("NEAR", 1, r"CONTAINS\((?:.*)?\bNEAR\("),
    ("TO_CHAR", 0.1, r"TO_CHAR\([^,)]+\)"), ("TO_NCHAR", 0.1, r"TO_NCHAR\([^,)]+\)"), ("ANYDATA", 2, r"\sANYDATA"), ("CONCAT", 0.1, r"\|\|"), ("TIMEZONE", 1, r"TIMEZONE_(REGION|ABBR)"), ("JSON", 3, r"IS\s+(NOT)?\s*JSON"), ("TO_CLOB", 0.1, r"TO_CLOB\([^,)]+\)"),
    ("ADD CONSTRAINT", 3, "ADD CONSTRAINT"), ("'SSSSS'", 2, r",\s*'SSSSS'\s*\)"), ("'J'", 2, r",\s*'J'\s*\)"), ("WHEN OTHER", 10, r"WHEN\s+OTHERS?\s+THEN"),
]
# Methods of XML types, three each.
XML_METHODS = "XMLTYPE CREATENONSCHEMABASEDXML CREATESCHEMABASEDXML CREATEXML EXISTSNODE GETNAMESPACE GETROOTELEMENT GETSCHEMAURL ISFRAGMENT ISSCHEMABASED ISSCHEMAVALID ISSCHEMAVALIDATED SCHEMAVALIDATE SETSCHEMAVALIDATED TOOBJECT TRANSFORM".split()
ORACLE_RULES += [(m, 3, rf"\b{m}\(") for m in XML_METHODS]
#: Functions without a translation: one each, if present at all.
ORACLE_FUNCTIONS = """AsciiStr Compose Decompose Dump VSize Bin_To_Num CharToRowid HexToRaw NumToDSInterval NumToYMInterval RawToHex To_Clob To_DSInterval To_Lob To_Multi_Byte To_NClob To_Single_Byte To_YMInterval BFilename
Cardinality Group_ID LNNVL NANVL Sys_Context Uid UserEnv BitAnd Median Remainder DbTimeZone New_Time SessionTimeZone Tz_Offset Get_Env From_Tz""".split()
# Difficulties of MySQL code, and its functions without a translation, two each.
MYSQL_RULES = [
    ("ARRAY_AGG_DISTINCT", 1, r"(ARRAY_AGG|GROUP_CONCAT)\(\s*DISTINCT"), ("SOUNDS LIKE", 1, r"\bSOUNDS\s+LIKE\b"), ("CHARACTER SET", 1, r"CHARACTER\s+SET"), ("COUNT(DISTINCT)", 2, r"\bCOUNT\(\s*DISTINCT\b"), ("MATCH", 2, r"\bMATCH.*AGAINST\b"),
    ("JSON", 2, r"\bJSON_[A-Z_]+\("), ("LOCK", 2, r"_(un)?lock\("), ("@VAR", 0.1, r"(?<![\w@])@+[A-Z0-9_]+"),
]
MYSQL_FUNCTIONS = """AES_DECRYPT AES_ENCRYPT ASYMMETRIC_DECRYPT ASYMMETRIC_DERIVE ASYMMETRIC_ENCRYPT ASYMMETRIC_SIGN ASYMMETRIC_VERIFY CREATE_ASYMMETRIC_PRIV_KEY CREATE_ASYMMETRIC_PUB_KEY CREATE_DH_PARAMETERS CREATE_DIGEST DECODE
DES_DECRYPT DES_ENCRYPT ENCODE ENCRYPT SHA1 SHA2 COLLATION COMPRESS CONVERT DEFAULT FOUND_ROWS GTID_SUBSET GTID_SUBTRACT INET6_ATON INET6_NTOA INTERVAL IS_FREE_LOCK IS_IPV4_COMPAT IS_IPV4_MAPPED IsEmpty LAST_INSERT_ID LOAD_FILE
MASTER_POS_WAIT MATCH OLD_PASSWORD PERIOD_ADD PERIOD_DIFF RANDOM_BYTES ROW_COUNT SQL_THREAD_WAIT_AFTER_GTIDS WAIT_UNTIL_SQL_THREAD_AFTER_GTIDS UNCOMPRESS UNCOMPRESSED_LENGTH UpdateXML UUID_SHORT VALIDATE_PASSWORD_STRENGTH WEIGHT_STRING""".split()
# Difficulties of T-SQL code, and its functions without a translation, two each.
TSQL_RULES = [
    ("ARRAY_AGG_DISTINCT", 1, r"(ARRAY_AGG|GROUP_CONCAT)\(\s*DISTINCT"), ("FOREIGN_OBJECT", 6, r"\b[a-z0-9_$]+\.[a-z0-9_$]+\.[a-z0-9_$]+\b"), ("SYS_OBJECT", 6, r"\b(master|model|msdb|tempdb)\.\b"), ("OBJECT_ID", 2, r"\bOBJECT_ID\s*\("),
    ("SYS_OBJECT", 6, r"[\s,]sys[a-z]+"), ("GLOBAL_TEMP_TABLE", 2, r"(?<![\w#])##[a-z0-9_$]+\b"), ("INTO_TEMP_TABLE", 1, r"(?<!INSERT)\sINTO\s+#+[a-z0-9_$]+\b"), ("SELECT_TOP", 0.2, r"\bSELECT\s+TOP\s+\d+\b"), ("COLLATE", 0.2, r"\sCOLLATE\s"),
    ("RETURNS_TABLE", 1, r"\bRETURNS\s+TABLE\s"), ("TODATETIMEOFFSET", 3, r"\bTODATETIMEOFFSET\s*\("), ("CURSOR", 0.2, r"\bCURSOR\s*\("), ("GLOBAL_VARIABLE", 1, r"(?<![\w@])@@[a-z0-9_$]+"), ("GLOBAL_VARIABLE", -1, r"(?<![\w@])@@(ROWCOUNT|VERSION|LANGUAGE)"),
    ("PIVOT", 12, r"\s(UNPIVOT|PIVOT)\s*"), ("TRY_CATCH", 3, r"\bBEGIN\s+TRY\s"), ("SP_FCT", 3, r"EXEC.*(\.|\s)SP_[A-Z_]+\b"), ("XML_FCT", 3, r"\.(value|nodes|query|exists|modify)\s*\("), ("FOR_XML", 6, r"\bFOR\s+XML\b"), ("INTERNAL", 100, r"\sinternal\."),
]
TSQL_FUNCTIONS = """ATN2 CHARINDEX CONVERT DATEADD DATEDIFF DATEFROMPARTS DATENAME DATEPART DAY ERROR_LINE ERROR_MESSAGE ERROR_NUMBER ERROR_PROCEDURE ERROR_SEVERITY ERROR_STATE GETDATE GETUTCDATE IIF ISDATE ISNULL ISNUMERIC MONTH NCHAR NULLIF
PATINDEX PRINT RAISERROR QUOTENAME RAND REPLICATE SESSIONPROPERTY SOUNDEX SPACE SQUARE STR STUFF SYSDATETIME SYSTEM_USER UNICODE YEAR""".split()
DIALECTS = {
    "oracle": (ORACLE_RULES, [(f, 1, rf"\b{f}\b") for f in ORACLE_FUNCTIONS]),
    "mysql": (MYSQL_RULES, [(f, 2, rf"\b{f}\b") for f in MYSQL_FUNCTIONS]),
    "tsql": (TSQL_RULES, [(f, 2, rf"\b{f}\s*\(") for f in TSQL_FUNCTIONS]),
}
#: Patterns in which something is sought anywhere behind something else, by what they mean: (parts of the text, head, last sign of the head, tail,
#: a word of the tail). A greedy search takes the first head to the last tail of a part, so a part counts once; sought
#: as they stand, each head would scan the rest of a long text again. (A link with WHERE at the beginning of a name is not seen.)
AHEAD = {
    r"FROM[^;]*\bTABLE\s*\(": (";", "FROM", "M", r"\bTABLE\s*\(", "TABLE"),
    r"(FROM|EXEC)((?!WHERE).)*\b[\w_]+@[\w_]+\b": ("(?i)WHERE", "(?:FROM|EXEC)", "M", r"\b\w+@\w+\b", "@"),
    r"\bSCORE\((?:.*)?\bCONTAINS\(": (None, r"\bSCORE\(", "(", r"\bCONTAINS\(", "CONTAINS("),
    r"CONTAINS\((?:.*)?\bFUZZY\(": (None, r"CONTAINS\(", "(", r"\bFUZZY\(", "FUZZY("),
    r"CONTAINS\((?:.*)?\bNEAR\(": (None, r"CONTAINS\(", "(", r"\bNEAR\(", "NEAR("),
    r"\bMATCH.*AGAINST\b": (None, r"\bMATCH", "H", r"AGAINST\b", "AGAINST"),
    r"EXEC.*(\.|\s)SP_[A-Z_]+\b": (None, "EXEC", "C", r"(?:\.|\s)SP_[A-Z_]+\b", "SP_"),
}
# Where the reference's counting departs from what its rules mean: rules whose weight or pattern differs, and rules
# that are counted once more.
COMPAT_CHANGED = {("oracle", "MERGE INTO"): (0, None), ("oracle", "WHEN OTHER"): (10, r"WHEN\s+OTHER\s+THEN"), ("mysql", "JSON"): (0, None)}
COMPAT_AGAIN = {"oracle": [("EXTRACT", 3, r"EXTRACT\("), ("HTP", 0.2, r"\bHT[PF]\.")]}
# Words that need quotes as names.
RESERVED = "ALL ANALYSE ANALYZE AND ANY ARRAY AS ASC BOTH CASE CAST CHECK COLLATE COLUMN CONSTRAINT CREATE DEFAULT DESC DISTINCT DO ELSE END EXCEPT FALSE FETCH FOR FOREIGN FROM GRANT GROUP HAVING IN INTO LEADING LIMIT NOT NULL OFFSET ON ONLY OR ORDER PRIMARY REFERENCES SELECT TABLE THEN TO TRAILING TRUE UNION UNIQUE USER USING WHEN WHERE WINDOW WITH".split()


def _literal(pattern: str) -> str | None:
    """A word that any match of a rule's pattern holds, in upper case; None if the pattern does not begin with one.

    It is read off the pattern: the letters behind leading marks that stand for no character, up to the first
    mark, less the last letter where a mark makes it optional. A pattern of alternatives has none.
    """
    if "|" in re.sub(r"\\.", "", pattern):
        return None
    found = re.match(r"(?:\\b|\\s[+*]?|\(\?<!\[[^\]]*\]\))*((?:[A-Za-z_@#]|\\\|)+)(.?)", pattern)
    if not found:
        return None
    word = found[1].replace("\\", "").upper()
    if found[2] and found[2] in "?*{":
        word = word[:-1]
    return word if len(word) > 1 else None


def _count_ahead(text: Column, upper: Column, pattern: str) -> Column:
    """How many parts of a text have the head of such a pattern before its tail: a few passes over the text, however many heads it has."""
    parts, head, last, tail, word = AHEAD[pattern]
    pieces = F.split(text, parts) if parts else F.array(text)
    rest = lambda piece: F.concat(F.lit(last), F.regexp_extract(piece, f"(?is){head}(.*)$", 1))
    return F.when(F.contains(upper, F.lit(word)), F.size(F.filter(pieces, lambda piece: rest(piece).rlike(f"(?is)(?<=.){tail}"))).cast("double")).otherwise(F.lit(0.0))


def score_details(code: DataFrame, dialect: str = "oracle", by: Sequence[str] = ("db", "object_type", "name"), compat: bool = False) -> DataFrame:
    """``(*by, keyword, n, cost)``: what each piece of code has of each difficulty, with TEST and SIZE.

    Texts are dealt anew, so that one large file does not keep one task busy, and each pattern is
    tried only on texts that hold its first word. Only counts that are not zero become rows, and
    a repeated name's are added up. ``compat`` counts as the reference does (fixed values below).
    """
    rules, functions = DIALECTS[dialect]
    if compat:
        changed = {k: COMPAT_CHANGED.get((dialect, k), (None, None)) for k, _, _ in rules}
        rules = [(k, w if changed[k][0] is None else changed[k][0], changed[k][1] or p) for k, w, p in rules] + COMPAT_AGAIN.get(dialect, [])
    dealt = code.select(*by, F.upper("object_type").alias("_type"), F.coalesce("code", F.lit("")).alias("_code")).repartition(int(code.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
    dealt = dealt.withColumn("_upper", F.upper("_code"))
    text = F.col("_code")

    def gated(pattern: str, count: Column) -> Column:
        word = _literal(pattern)
        return count if word is None else F.when(F.contains("_upper", F.lit(word)), count).otherwise(F.lit(0.0))

    def counts(pattern: str) -> Column:
        return _count_ahead(text, F.col("_upper"), pattern) if pattern in AHEAD else F.regexp_count(text, F.lit(f"(?is){pattern}")).cast("double")

    counted = [F.struct(F.lit(k).alias("keyword"), gated(p, counts(p)).alias("n"), F.lit(float(w)).alias("weight")) for k, w, p in rules]
    present = [F.struct(F.lit(k).alias("keyword"), gated(p, text.rlike(f"(?i){p}").cast("double")).alias("n"), F.lit(float(w)).alias("weight")) for k, w, p in functions]
    tested = (~F.col("_type").isin(*UNTESTED)).cast("double")
    size = F.greatest(F.floor(F.length(text) / SIZE_UNIT[dialect]), F.lit(1)).cast("double") * tested
    fixed = [F.struct(F.lit("TEST").alias("keyword"), F.lit(1.0).alias("n"), (tested * TEST_COST).alias("weight")), F.struct(F.lit("SIZE").alias("keyword"), F.lit(1.0).alias("n"), size.alias("weight"))]
    found = F.filter(F.array(*fixed, *counted, *present), lambda x: (x["n"] != 0) & (x["weight"] != 0))
    rows = dealt.select(*by, F.explode(found).alias("x")).select(*by, "x.keyword", F.when(F.col("x.weight") < 0, -F.col("x.n")).otherwise(F.col("x.n")).alias("n"), (F.col("x.n") * F.col("x.weight")).alias("cost"))
    return rows.groupBy(*by, "keyword").agg(F.sum("n").cast("long").alias("n"), F.round(F.sum("cost"), 6).alias("cost"))


def score(code: DataFrame, dialect: str = "oracle", by: Sequence[str] = ("db", "object_type", "name")) -> DataFrame:
    """``(*by, cost)`` of each piece of code; see :func:`score_details`."""
    return score_details(code, dialect, by).groupBy(*by).agg(F.round(F.sum("cost"), 6).alias("cost"))


def object_counts(catalog: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, object_type, n_objects, n_invalid)``."""
    return catalog.groupBy(*by, "object_type").agg(F.count(F.lit(1)).alias("n_objects"), F.count_if(F.upper("status") == "INVALID").alias("n_invalid"))


def object_cost(counts: DataFrame) -> DataFrame:
    """Add ``object_cost``: number by weight, up to the cap of the type."""
    table = lambda d: F.create_map(*chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in d.items()))
    plain = F.col("n_objects") * F.coalesce(F.try_element_at(table(OBJECT_WEIGHTS), F.upper("object_type")), F.lit(0.0))
    return counts.withColumn("object_cost", F.round(F.least(plain, F.coalesce(F.try_element_at(table(OBJECT_CAPS), F.upper("object_type")), F.lit(float("inf")))), 6))


def to_days(cost: Column, unit_minutes: float = UNIT_MINUTES) -> Column:
    """Person-days of a cost."""
    return cost * unit_minutes / 60 / DAY_HOURS


def migration_level(days: Column, code_cost: Column, has_code: Column, complex_code: Column, limit: float = HUMAN_DAYS_LIMIT) -> Column:
    """A-1 to C-5: the letter says how much by itself (A), by hand within the limit (B) or beyond it (C); the number says how hard."""
    letter = F.when(code_cost <= 0, "A").when(days > limit, "C").otherwise("B")
    number = F.when(~has_code, 1).when(~complex_code & (code_cost <= 0), 2).when(~complex_code, 3).when(days <= limit, 4).otherwise(5)
    return F.concat(letter, F.lit("-"), number.cast("string"))


def assessment_report(catalog: DataFrame, code: DataFrame | None, dialect: str = "oracle", by: Sequence[str] = (), unit_minutes: float = UNIT_MINUTES, details: DataFrame | None = None) -> DataFrame:
    """``(*by, object_type, n_objects, n_invalid, cost, days)`` with a total (object_type null) per group; see :func:`with_comments` for the remarks.

    ``details``, of :func:`score_details`, spares another pass over the code.
    """
    counts = object_cost(object_counts(catalog, by))
    details = score_details(code, dialect, [*by, "object_type", "name"]) if details is None else details
    costs = details.groupBy(*by, "object_type").agg(F.round(F.sum("cost"), 6).alias("code_cost"))
    both = counts.join(costs, [*by, "object_type"], "full_outer").fillna(0)
    total = F.round(F.sum(F.col("object_cost") + F.col("code_cost")), 6)
    rows = both.rollup(*by, "object_type").agg(F.sum("n_objects").alias("n_objects"), F.sum("n_invalid").alias("n_invalid"), total.alias("cost"), F.grouping_id().alias("_g"))
    return rows.where("_g < 2").drop("_g").withColumn("days", F.round(to_days(F.col("cost"), unit_minutes), 4))


def with_comments(report: DataFrame, details: DataFrame, by: Sequence[str] = (), most: int = 5) -> DataFrame:
    """A report with ``comment``: the difficulties that cost most of each type, with their numbers, the dearest first, ties by name.

    A type has at most as many keywords as there are rules, so no list is long.
    """
    keys = [*by, "object_type"]
    totals = details.where("keyword not in ('TEST', 'SIZE') and cost > 0").groupBy(*keys, "keyword").agg(F.sum("n").alias("n"), F.round(F.sum("cost"), 6).alias("cost"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("cost")).alias("c"), "keyword", "n")))
    named = totals.groupBy(*keys).agg(F.array_join(F.transform(F.slice(order, 1, most), lambda x: F.concat(x["keyword"], F.lit(": "), x["n"].cast("string"))), ", ").alias("comment"))
    r, c = report.alias("r"), named.alias("c")
    match = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    return r.join(c, match, "left").select("r.*", F.coalesce("c.comment", F.lit("")).alias("comment"))


def assess_many(catalog: DataFrame, code: DataFrame, dialect: str = "oracle", limit: float = HUMAN_DAYS_LIMIT) -> DataFrame:
    """One row per database: objects, cost, days and level."""
    # Sums by type and keyword serve both, and are few.
    details = score_details(code, dialect, ("db", "object_type", "name")).groupBy("db", "object_type", "keyword").agg(F.sum("cost").alias("cost"))
    details = checkpoint(details)
    report = assessment_report(catalog, None, dialect, ("db",), details=details).where("object_type is null and db is not null").drop("object_type")
    hard = details.where("keyword not in ('TEST', 'SIZE')").groupBy("db").agg(F.sum("cost").alias("difficulty"))
    kinds = catalog.groupBy("db").agg(F.max(F.upper("object_type").isin("FUNCTION", "PROCEDURE", "PACKAGE BODY", "TRIGGER")).alias("has_code"))
    both = report.join(kinds, "db", "left").join(hard, "db", "left").fillna(0.0, ["difficulty"])
    return both.withColumn("level", migration_level(F.col("days"), F.col("difficulty"), F.coalesce("has_code", F.lit(False)), F.col("difficulty") > 20, limit))


def normalise_sql(text: Column) -> Column:
    """A statement without comments, literals as ?, white space as one space, upper case."""
    plain = F.regexp_replace(text, r"(?s)/\*.*?\*/|--[^\n]*", " ")
    plain = F.regexp_replace(plain, r"'(?:[^']++|'')*+'", "?")
    plain = F.regexp_replace(plain, r"\b\d+(?:\.\d+)?\b", "?")
    return F.upper(F.trim(F.regexp_replace(plain, r"\s+", " ")))


def audit_queries(log: DataFrame, users: Sequence[str] = ()) -> DataFrame:
    """``(statement, n)``: queries and changes of an audit log, alike ones together."""
    kept = log.where(F.upper("action_name").isin("SELECT", "INSERT", "UPDATE", "DELETE", "MERGE"))
    if users:
        kept = kept.where(F.upper("username").isin(*map(str.upper, users)))
    return kept.groupBy(normalise_sql(F.col("sql_text")).alias("statement")).agg(F.count(F.lit(1)).alias("n"))


def show_columns(catalog: DataFrame, dialect: str = "oracle") -> DataFrame:
    """A catalog with mapped types, a mark for review, and a warning for reserved words."""
    from ferrywright.functions.types import map_types

    return map_types(catalog, dialect).withColumn("reserved_word", F.upper("column_name").isin(*RESERVED))


def kind_counts(catalog: DataFrame, kind: str, by: Sequence[str] = ("object_type",)) -> DataFrame:
    """How many objects of each kind, as reports comment them."""
    return catalog.groupBy(*by, kind).agg(F.count(F.lit(1)).alias("n"))


def schema_size(catalog: DataFrame) -> DataFrame:
    """``(owner, size_mb)``."""
    return catalog.groupBy("owner").agg((F.sum("bytes") / 1024 / 1024).alias("size_mb"))
