"""Secret scan over a trigram inverted index, in DataFrame operations only (operator 10).

Each rule's regex is turned into a Boolean query over trigrams that any match must
contain. An inverted index, restricted to the trigrams of the rule set, maps a
trigram and a shard of documents to a posting list; intersecting postings gives
the candidates of a rule, and its regex verifies them. A rule without a mandatory
trigram scans all documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, spans

#: Documents of a shard, in expectation, and so the length of a posting list.
SHARD_DOCS = 4096
#: Sets of literal strings larger than this are no longer told apart when queries are derived.
MAX_STRINGS = 32


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regex that Java's engine reads and :func:`parse_pattern` too; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: The base rules, then well-known token formats, which add spans.
RULES = (
    Rule("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]++)", 1, 6, True),
    Rule("access", r"AKIA[A-Z0-9]++", 0, 20, True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", 0, 24, True),
    Rule("github", r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,255}+|github_pat_[A-Za-z0-9_]{22,255}+)"),
    Rule("slack", r"(?<![A-Za-z0-9])xox[abeoprs]-[A-Za-z0-9-]{10,250}+"),
    Rule("google", r"(?<![A-Za-z0-9])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    Rule("stripe", r"(?<![A-Za-z0-9])[rs]k_live_[A-Za-z0-9]{20,250}+"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
KINDS = [r.kind for r in RULES]


def parse_pattern(pattern: str) -> list[tuple]:
    """A rule's regex as nodes: ``("char", characters)``, None for too many to list; ``("around",)`` for what has no width; ``("repeat", least, most, nodes)``; ``("branch", [nodes, ..])``.

    What rules may use: characters and escapes, sets, groups of all kinds, alternatives, and repeats, lazy or
    possessive ones like greedy ones, as a query needs no more than what matches can hold. A back-reference is an error.
    """
    at = 0

    def escape() -> frozenset | None:
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "x":
            at += 2
            return frozenset(chr(int(pattern[at - 2 : at], 16)))
        if c.isdigit():
            raise ValueError(f"{pattern!r} has a back-reference")
        named = {"n": "\n", "t": "\t", "r": "\r", "f": "\f"}
        return frozenset(named.get(c, c)) if c in named or not c.isalpha() else None

    def one_of() -> frozenset | None:
        nonlocal at
        found: set[str] | None = set()
        if pattern[at] == "^":
            found, at = None, at + 1
        first = True
        while first or pattern[at] != "]":
            first = False
            c = pattern[at]
            at += 1
            got = escape() if c == "\\" else frozenset(c)
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                c = pattern[at]
                at += 1
                high = escape() if c == "\\" else frozenset(c)
                got = frozenset(map(chr, range(ord(min(got)), ord(min(high)) + 1))) if got and high else None
            found = found | got if found is not None and got is not None else None
        at += 1
        return frozenset(found) if found is not None else None

    def alternatives() -> list[tuple]:
        nonlocal at
        branches, nodes = [], []
        while at < len(pattern) and pattern[at] != ")":
            c = pattern[at]
            at += 1
            if c == "|":
                branches.append(nodes)
                nodes = []
                continue
            if c == "(":
                around = False
                if pattern.startswith("?", at):
                    opened = re.compile(r"\?(?:(:|>|[a-zA-Z-]+:|<[A-Za-z]\w*>|P<\w+>)|(=|!|<=|<!))").match(pattern, at)
                    if not opened:
                        raise ValueError(f"{pattern!r} has a group of a kind that rules do not use")
                    around, at = bool(opened[2]), opened.end()
                inner = alternatives()
                if at == len(pattern):
                    raise ValueError(f"{pattern!r} leaves a group open")
                at += 1
                node = ("around",) if around else ("branch", [inner])
            elif c == "[":
                node = ("char", one_of())
            elif c == "\\":
                node = ("around",) if pattern[at] in "bBAzZG" else ("char", escape())
                at += pattern[at] in "bBAzZG" and node == ("around",)
            elif c in "^$":
                node = ("around",)
            else:
                node = ("char", None if c == "." else frozenset(c))
            counted = re.compile(r"(?:([?*+])|\{(\d+)(,?)(\d*)\})[+?]?").match(pattern, at)
            if counted:
                at = counted.end()
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[counted[1]] if counted[1] else (int(counted[2]), int(counted[4]) if counted[4] else None if counted[3] else int(counted[2]))
                node = ("repeat", least, most, [node])
            nodes.append(node)
        return [("branch", [*branches, nodes])] if branches else nodes

    found = alternatives()
    if at < len(pattern):
        raise ValueError(f"{pattern!r} closes a group that it does not open")
    return found


def _strings(nodes: list[tuple]) -> tuple[set[str] | None, frozenset]:
    """Of a parsed regex: the strings it can match, None for too many, and the Boolean query that all matches meet.

    A query is a frozenset of alternatives, each a frozenset of trigrams that occur
    together; the query with one empty alternative holds for every text.
    """
    anything = frozenset([frozenset()])
    exact: set[str] | None = {""}
    query = anything

    def both(a: frozenset, b: frozenset) -> frozenset:
        out = {x | y for x in a for y in b}
        return frozenset(x for x in out if not any(y < x for y in out))

    def of_strings(found: set[str]) -> frozenset:
        alternatives = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in found}
        return anything if frozenset() in alternatives else frozenset(alternatives)

    for at, (op, *value) in enumerate(nodes):
        if op == "char":
            few = value[0] is not None and len(value[0]) <= MAX_STRINGS
            part, inner = ({c.lower() for c in value[0]} if few else None), anything
        elif op == "around":
            # What stands around a match is not part of it.
            part, inner = {""}, anything
        elif op == "branch":
            branches = [_strings(b) for b in value[0]]
            part = set().union(*(b[0] for b in branches)) if all(b[0] is not None for b in branches) else None
            inner = frozenset().union(*(of_strings(b[0]) if b[0] is not None else b[1] for b in branches))
            inner = anything if frozenset() in inner or part is not None else inner
        else:
            least, most, held = value
            part, inner = _strings(held)
            if (least, most) == (0, 1):
                part, inner = (part | {""} if part is not None else None), anything
            elif least >= 1:
                part, inner = None, of_strings(part) if part is not None else inner
            else:
                part, inner = None, anything
        joined = {a + b for a, b in product(exact, part)} if exact is not None and part is not None else None
        if joined is not None and len(joined) <= MAX_STRINGS:
            exact = joined
            query = both(query, inner)
            continue
        if exact is not None:
            query = both(query, of_strings(exact))
        query = both(query, inner)
        # From here on strings begin anew: what follows is sought by itself.
        after, more = _strings(nodes[at + 1 :])
        if part is not None:
            query = both(query, of_strings(part))
        query = both(query, both(more, of_strings(after) if after is not None else anything))
        return None, query
    return exact, query


def trigram_query(pattern: str) -> list[list[str]]:
    """Alternatives of trigrams, in lower case, one of which every match of the very regex that verifies holds in full; [] if it has no mandatory trigram."""
    exact, query = _strings(parse_pattern(pattern))
    if exact is not None:
        query = frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in exact)
    return [] if frozenset() in query else sorted(sorted(a) for a in query)


def build_index(docs: DataFrame, grams: list[str], shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The inverted index ``(gram, shard, postings)`` of rows with ``key`` and ``text``, for the given trigrams of lower-cased texts.

    Shards are dealt by the key, so that the list of a trigram that most texts
    have is cut into lists of about ``shard_docs`` keys.
    """
    low = docs.select("key", F.lower("text").alias("low"))
    held = F.filter(F.array(*map(F.lit, grams)), lambda g: F.contains("low", g)) if grams else F.array().cast("array<string>")
    n = docs.select(F.count(F.lit(1))).first()[0]
    shard = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-n // shard_docs)))).cast("int")
    return low.select("key", F.explode(held).alias("gram")).withColumn("shard", shard).groupBy("gram", "shard").agg(F.collect_set("key").alias("postings"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(key, rules)``: keys whose postings meet a rule's query, and which rules, by number. Rules without a query are not in it."""
    wanted = [(r, a, gram, len(grams)) for r, rule in enumerate(rules) for a, grams in enumerate(trigram_query(rule.pattern)) for gram in grams]
    spark = index.sparkSession
    # As many rows as the rule set has trigrams.
    query = F.broadcast(spark.createDataFrame(wanted, "rule int, alternative int, gram string, need int"))
    postings = index.join(query, "gram").select("rule", "alternative", "need", F.explode("postings").alias("key"))
    met = postings.groupBy("key", "rule", "alternative", "need").agg(F.count(F.lit(1)).alias("n")).where("n = need")
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added)``, one row per row of ``docs``.

    Counts and digest are of the base spans; spans has these and the other rules'. A
    null or empty text has none; null ids and repeated rows are carried, each
    with its own result; an empty table gives no row; extra columns are ignored.
    The key of a row is a hash of its id and text: rows that share one only share candidates.
    """
    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty("text").alias("text"))
    keyed = slim.withColumn("key", F.xxhash64("doc_id", "text"))
    grams = sorted({g for rule in rules for alternative in trigram_query(rule.pattern) for g in alternative})
    index = common.stage(build_index(keyed, grams), "trigram-index")
    found = common.stage(candidates(index, rules), "secret-candidates")
    told = keyed.join(found, "key", "left").withColumn("rules", F.coalesce("rules", F.array().cast("array<int>")))
    gates = {rule.kind: F.lit(True) if not trigram_query(rule.pattern) else F.array_contains("rules", r) for r, rule in enumerate(rules)}
    told = spans.add_matches(told, "text", {rule.kind: (rule.pattern, gates[rule.kind]) for rule in rules})
    told = told.withColumns({f"v_{r.kind}": F.when(F.size(f"m_{r.kind}") > 0, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group))).otherwise(F.col(f"m_{r.kind}")) for r in rules if r.group})

    def kept(number: int, rule: Rule) -> Column:
        values = f"v_{rule.kind}" if rule.group else f"m_{rule.kind}"
        three = F.zip_with(F.arrays_zip(F.col(f"s_{rule.kind}").alias("s"), F.col(f"m_{rule.kind}").alias("m")), values, lambda p, v: F.struct(p["s"].alias("s"), p["m"].alias("m"), v.alias("v")))
        good = F.filter(three, lambda p: F.length(p["v"]) >= rule.least)
        return F.transform(good, lambda p: F.struct(p["s"].cast("int").alias("start"), F.lit(number).alias("kind"), (p["s"] + F.length(p["m"])).cast("int").alias("end"))).cast(spans.SPAN)

    base = F.concat(*[kept(k, r) for k, r in enumerate(rules) if r.base])
    added = [kept(k, r) for k, r in enumerate(rules) if not r.base]
    told = told.select("doc_id", base.alias("base"), (F.concat(*added) if added else F.array().cast(spans.SPAN)).alias("added"))
    kinds = [r.kind for r in rules]
    return told.select(
        "doc_id", *[spans.count_of(F.col("base"), k).alias(f"n_{r.kind}") for k, r in enumerate(rules) if r.base],
        F.sha2(spans.joined(F.col("base"), kinds).cast("binary"), 256).alias("base_sha256"), spans.joined(F.concat("base", "added"), kinds).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document of ``documents``."""
    return find_secrets(common.table(spark, sf_dir, "documents"))
