"""A corpus of code that meets every counter and every listed function of each dialect, over the parts table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.plans import assessment
from ferrywright.plans.tables import table

#: Of each counter a piece of code, and what is counted in it where that is not its own keyword once.
ORACLE = [
    ("IS TABLE OF", "type t IS TABLE OF x"), ("OUTER JOIN", "a = b(+)"), ("CONNECT BY", "CONNECT  BY x"), ("BULK COLLECT", "BULK COLLECT x"), ("FORALL", "FORALL i"), ("GOTO", "GOTO l"), ("ROWNUM", "ROWNUM < 2"), ("ROWID", "ROWID = 1"), ("UROWID", "u UROWID"),
    ("SQLCODE", "SQLSTATE"), ("IS RECORD", "t IS RECORD"), ("TABLE", "FROM a, TABLE (x)"), ("PIPE ROW", "PIPE ROW x"), ("DBMS_", "DBMS_LOB.x"), ("DBMS_", "DBMS_STANDARD.RAISE EXCEPTION", {"DBMS_": (0, 0)}), ("UTL_", "UTL_FILE.x"), ("CTX_", "CTX_DDL.x"),
    ("EXTRACT", "EXTRACT (y)"), ("TO_NUMBER", "TO_NUMBER (x)"), ("EXCEPTION", "PROGRAM_ERROR"), ("EXCEPTION", "DUP_VAL_ON_INDEX"), ("PLUNIT", "PLUNIT"), ("HTP", "HTP.p"), ("ADD_MONTHS", "ADD_MONTHS"), ("LAST_DAY", "LAST_DAY"), ("NEXT_DAY", "NEXT_DAY"),
    ("MONTHS_BETWEEN", "MONTHS_BETWEEN"), ("DBMS_OUTPUT.put", "DBMS_OUTPUT.put(x)", {"DBMS_": (0, 0), "DBMS_OUTPUT.put": (1, 1)}), ("TRUNC", "TRUNC (d)"), ("REGEXP_LIKE", "REGEXP_LIKE"), ("REGEXP_SUBSTR", "REGEXP_SUBSTR"), ("REGEXP_COUNT", "REGEXP_COUNT"),
    ("REGEXP_INSTR", "REGEXP_INSTR"), ("PLVDATE", "PLVDATE"), ("PLVSTR", "PLVSTR"), ("PLVCHR", "PLVCHR"), ("PLVSUBST", "PLVSUBST"), ("PLVLEX", "PLVLEX"), ("CURSOR", "REF CURSOR"), ("ORA_ROWSCN", "ORA_ROWSCN"), ("SAVEPOINT", "SAVEPOINT"), ("DBLINK", "FROM t@link"),
    ("ISOPEN", "c%ISOPEN"), ("ROWCOUNT", "c%ROWCOUNT"), ("SDO_", "SDO_GEOM"), ("PRAGMA", "PRAGMA EXCEPTION_INIT"), ("MDSYS", "MDSYS.X"), ("MERGE INTO", "MERGE INTO t"), ("CONTAINS", "CONTAINS(a, b)"), ("SCORE", "SCORE(1) then CONTAINS(a)", {"SCORE": (1, 1), "CONTAINS": (1, 1)}),
    ("FUZZY", "CONTAINS(a, FUZZY(b", {"FUZZY": (1, 1), "CONTAINS": (1, 1)}), ("NEAR", "CONTAINS(a, NEAR(b", {"NEAR": (1, 1), "CONTAINS": (1, 1)}), ("TO_CHAR", "TO_CHAR(x)"), ("TO_NCHAR", "TO_NCHAR(x)"), ("ANYDATA", "x ANYDATA"), ("CONCAT", "a || b"),
    ("TIMEZONE", "TIMEZONE_REGION"), ("JSON", "x IS NOT JSON"), ("TO_CLOB", "TO_CLOB(x)", {"TO_CLOB": (1, 0.1), "To_Clob": (1, 1)}), ("ADD CONSTRAINT", "ADD CONSTRAINT c"), ("'SSSSS'", "f(d, 'SSSSS')"), ("'J'", "f(d, 'J')"), ("WHEN OTHER", "WHEN OTHERS THEN"),
    *[(m, f"x.{m}(y)") for m in assessment.XML_METHODS],
]
MYSQL = [
    ("ARRAY_AGG_DISTINCT", "GROUP_CONCAT( DISTINCT x)"), ("SOUNDS LIKE", "a SOUNDS LIKE b"), ("CHARACTER SET", "CHARACTER SET x"), ("COUNT(DISTINCT)", "COUNT(DISTINCT x)"), ("MATCH", "MATCH (a) AGAINST (b)", {"MATCH": (2, 4)}), ("JSON", "JSON_ARRAY(x)"),
    ("LOCK", "GET_LOCK(x)"), ("@VAR", "SET @a = 1"),
]
TSQL = [
    ("ARRAY_AGG_DISTINCT", "ARRAY_AGG(DISTINCT x)"), ("FOREIGN_OBJECT", "FROM a.b.c"), ("SYS_OBJECT", "FROM master.x"), ("OBJECT_ID", "OBJECT_ID (x)"), ("SYS_OBJECT", "FROM sysobjects"), ("GLOBAL_TEMP_TABLE", "FROM ##t"), ("INTO_TEMP_TABLE", "SELECT a INTO #t"),
    ("SELECT_TOP", "SELECT TOP 5 a"), ("COLLATE", "a COLLATE b"), ("RETURNS_TABLE", "RETURNS TABLE a"), ("TODATETIMEOFFSET", "TODATETIMEOFFSET (x)"), ("CURSOR", "CURSOR (x)"), ("GLOBAL_VARIABLE", "SET @@a"), ("GLOBAL_VARIABLE", "SET @@ROWCOUNT", {"GLOBAL_VARIABLE": (0, 0)}),
    ("PIVOT", "a PIVOT b"), ("TRY_CATCH", "BEGIN TRY a"), ("SP_FCT", "EXEC a.SP_HELP"), ("XML_FCT", "x.value (y)"), ("FOR_XML", "FOR XML a"), ("INTERNAL", "x internal.y"),
]
#: Code that is counted otherwise in the reference's way of counting.
COMPAT = [("EXTRACT", "EXTRACT(y)", {"EXTRACT": (2, 6)}), ("MERGE INTO", "MERGE INTO t", {}), ("WHEN OTHER", "WHEN OTHERS THEN", {}), ("WHEN OTHER", "WHEN OTHER THEN"), ("HTP", "HTF.p", {"HTP": (2, 0.4)})]
FORMS = {"oracle": "x := {} + 1", "mysql": "{} x", "tsql": "{} (x)"}


def examples(dialect: str) -> list[tuple[str, dict[str, tuple[float, float]]]]:
    """``(code, {keyword: (n, cost)})`` of a dialect, or of ``compat``."""
    own = {"oracle": ORACLE, "mysql": MYSQL, "tsql": TSQL, "compat": COMPAT}[dialect]
    rules, functions = assessment.DIALECTS["oracle" if dialect == "compat" else dialect]
    weights = {k: w for k, w, _ in rules if w > 0} | {f: w for f, w, _ in functions}
    out = [(code, rest[0] if rest else {keyword: (1, weights[keyword])}) for keyword, code, *rest in own]
    if dialect != "compat":
        out += [(FORMS[dialect].format(f), {f: (1, w)}) for f, w, _ in functions]
    return out


def e_every_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all parts' pieces of code have of each difficulty, by dialect; a part's piece goes by its key."""
    parts = []
    for dialect in ("oracle", "mysql", "tsql", "compat"):
        texts = [code for code, _ in examples(dialect)]
        code = table(spark, sf_dir, "part").select(F.lit(dialect).alias("db"), F.lit("VIEW").alias("object_type"), F.col("p_partkey").cast("string").alias("name"), F.get(F.array(*map(F.lit, texts)), (F.col("p_partkey") % len(texts)).cast("int")).alias("code"))
        details = assessment.score_details(code, "oracle" if dialect == "compat" else dialect, ("db",), compat=dialect == "compat")
        parts.append(details.where("keyword not in ('TEST', 'SIZE')").select(F.col("db").alias("dialect"), "keyword", "n", F.round("cost", 4).alias("cost")))
    return reduce(DataFrame.unionByName, parts)


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values, sizes = [], []
    for dialect in ("oracle", "mysql", "tsql", "compat"):
        found = examples(dialect)
        sizes.append(f"('{dialect}', {len(found)})")
        values += [f"('{dialect}', {i}, {quoted(k)}, {n}, {float(cost)})" for i, (_, counts) in enumerate(found) for k, (n, cost) in counts.items()]
    return f"""WITH v(dialect, i, keyword, n, cost) AS (VALUES {', '.join(values)}), s(dialect, size) AS (VALUES {', '.join(sizes)}), p AS (SELECT s.dialect, p_partkey % size AS i, count(*) AS times FROM part, s GROUP BY ALL)
        SELECT v.dialect, keyword, sum(n * times)::BIGINT AS n, round(sum(cost::DOUBLE * times), 4) AS cost FROM v JOIN p ON p.dialect = v.dialect AND p.i = v.i GROUP BY ALL"""


QUERIES = {"e_every_counter": (e_every_counter, _sql())}
