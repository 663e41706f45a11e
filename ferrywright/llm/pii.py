"""Personal data by weak supervision, in DataFrame operations only (operator 3).

Base matches are those of four fixed patterns. Wider patterns give further
candidates, on which labelers vote: a strict form, a gazetteer, the words before it,
a checksum. Expectation-maximisation over all counts of vote patterns estimates
each labeler's reliability; the posteriors train a linear classifier of span
features, whose verdict on each feature code decides which candidates become spans.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, spans

KINDS = ["email", "ip", "card", "phone"]
LOCAL = "[A-Za-z0-9._%+-]"

#: The base patterns for Java's engine. Possessive repeats and left borders skip starts that cannot
#: begin a leftmost match, so that long runs cost no more than their length; what they match is the same.
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9](?=(?:[\x20().-]*+[0-9]){8,14}+(?![\x20().-]*+[0-9]))[\x20().0-9-]+[0-9]"

#: Wider patterns: spelt-out mail addresses, IPv6 and ports, long digit groups, national phone numbers.
WIDE_EMAIL = rf"(?<!{LOCAL}){LOCAL}++\x20?(?:\[at\]|\(at\)|\{{at\}}|\x20at\x20)\x20?[A-Za-z0-9-]++(?:\x20?(?:\[dot\]|\(dot\)|\{{dot\}}|\x20dot\x20|\.)\x20?[A-Za-z0-9-]++)++"
WIDE_IP = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
WIDE_CARD = r"(?<![0-9])(?<![0-9][\x20.-])[0-9]{3,4}(?:[\x20.-][0-9]{4,6}){2,4}+(?![\x20.-]?[0-9])"
WIDE_PHONE = r"(?<![0-9+])(?<![0-9][\x20().-])(?:00[0-9]{1,3}[\x20.-])?(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?![\x20.-]?[0-9])"

#: Gazetteers. General top-level domains, two-letter country endings by their first letter, ranges of card issuers (four digits at
#: least are at hand), and international dialling codes by zone.
GENERAL_DOMAINS = "com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel cat tel asia post xyz online site shop store app dev cloud tech blog news email group team world life live media agency company".split()
COUNTRY_DOMAINS = """a[c-gil-oq-uwxz] b[abd-jl-oq-tvwyz] c[acdf-ik-oru-z] d[ejkmoz] e[ceghr-u] f[ijkmor] g[abd-ilmnp-uwy] h[kmnrtu] i[del-oq-t] j[emop] k[eghimnprwyz] l[abcikr-vy] m[ac-hk-z]
n[acefgilopruz] om p[ae-hk-nrstwy] qa r[eosuw] s[a-eg-or-vx-z] t[cdfghj-ortvwz] u[agksyz] v[aceginu] w[fs] y[et] z[amw]""".split()
DOMAINS = rf"(?i)[.\x20](?:{'|'.join(COUNTRY_DOMAINS + GENERAL_DOMAINS)})$"
ISSUERS = r"^(?:4|5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720|220[0-4]|3[47]|36|38|39|30[0-5]|3095|352[89]|35[3-8]|6011|64[4-9]|65|62|8[12]|508|50(?:18|20|38|6[01])|5893|6304|6759|676[1-3])"
DIALLING = """1 7 2[07] 21[12368] 22[0-9] 23[0-9] 24[0-9] 25[0-8] 26[0-9] 29[01789] 3[0-469] 35[0-9] 37[0-9] 38[0-35-79] 4[013-9] 42[013] 5[1-8] 50[0-9] 59[0-9]
6[0-6] 67[02-9] 68[0-35-9] 69[0-2] 8[1246] 85[02356] 87[08] 88[0-368] 9[0-58] 96[0-8] 97[0-79] 99[2-68]""".split()
AREAS = rf"^(?:00(?:{'|'.join(DIALLING)})[\x20.-]|\(0[1-9]|0[1-9]|\([2-9][0-9]{{2}}\)|[2-9][0-9]{{2}}[\x20.-][2-9])"
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|reach|correo|courriel)\W*(?:\w+\W+){0,3}$",
    "ip": r"(?i)(?:\bip\b|ipv6|address|host|server|from)\W*(?:\w+\W+){0,3}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|tarjeta|carte|karte)\W*(?:\w+\W+){0,3}$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|tel\.|telefon|tel[eé]fono|t[eé]l[eé]phone)\W*(?:\w+\W+){0,3}$",
}
CONTEXT = 40
#: Votes are 0 no, 1 yes for each of so many labelers.
LABELERS = ("form", "gazetteer", "cue", "check")
EM_ROUNDS = 100
ACCEPT_FROM = 0.5


def luhn(match: Column) -> Column:
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))
    total = F.aggregate(
        F.split(digits, ""),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("odd")),
        lambda acc, c: F.struct((acc["sum"] + F.when(acc["odd"] == 0, c.cast("int")).otherwise(F.floor(c.cast("int") * 2 / 10) + c.cast("int") * 2 % 10)).cast("int").alias("sum"), (1 - acc["odd"]).alias("odd")),
    )
    return total["sum"] % 10 == 0


def small_parts(match: Column) -> Column:
    """Whether each dotted number is at most 255."""
    return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$")


def with_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, candidates)`` of whole texts; a candidate has start, kind, end, votes and a feature code."""
    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty("text").alias("text"))
    text = F.col("text")
    digit = text.rlike("[0-9][\\x20().:-]{0,2}[0-9]")
    found = spans.add_matches(
        slim.withColumn("has_digit", digit), "text",
        {
            "email": (EMAIL, F.contains(text, F.lit("@"))), "ip": (IP, F.col("has_digit") | text.rlike(r"[0-9]\.[0-9]")), "card": (CARD, F.col("has_digit")), "phone": (PHONE, F.contains(text, F.lit("+"))),
            "wemail": (WIDE_EMAIL, text.rlike(r"[\[({\x20]at[\])}\x20]")), "wip": (WIDE_IP, text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:")), "wcard": (WIDE_CARD, F.col("has_digit")), "wphone": (WIDE_PHONE, F.col("has_digit")),
        },
    )
    true = lambda m: F.lit(True)
    base = F.concat(spans.kept_spans("email", 0, true), spans.kept_spans("ip", 1, small_parts), spans.kept_spans("card", 2, luhn), spans.kept_spans("phone", 3, true))
    wide = F.concat(*[candidates(name, k) for k, name in enumerate(("wemail", "wip", "wcard", "wphone"))])
    return found.select("doc_id", base.alias("base"), wide.alias("candidates"))


def candidates(name: str, kind: int) -> Column:
    """Candidates of one wide pattern with their votes and feature code."""
    before = lambda s: F.substr("text", F.greatest(F.lit(1), s + 1 - CONTEXT), F.least(s, F.lit(CONTEXT)))
    forms = (r"(?i)[a-z]{2,4}$", "^[0-9A-F:]+$|^[0-9a-f:]+$", r"^[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^3[0-9]{3}([\x20.-])[0-9]{6}\2[0-9]{5}$", r"^(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}$|^0[0-9]{2,4}[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}$")
    gazetteers = (DOMAINS, "(?i)^(?:20|2[4-9a-f]|fe8|f[cd])", ISSUERS, AREAS)
    digits = lambda m: F.length(F.regexp_replace(m, "[^0-9]", ""))
    checks = (lambda m: ~m.rlike(r"\.\x20|\x20at\x20(?:the|a|an|my|his|her|our|this|all)\b"), lambda m: ~m.rlike("(?i)^(?:[0-9]{1,2}:)+[0-9]{1,2}$"), luhn, lambda m: digits(m).between(9, 13))

    def one(s: Column, m: Column) -> Column:
        flags = [m.rlike(forms[kind]), m.rlike(gazetteers[kind]), before(s).rlike(CUES[KINDS[kind]]), checks[kind](m)]
        vote = sum((f.cast("int") * (1 << i) for i, f in enumerate(flags[1:], 1)), flags[0].cast("int"))
        n = digits(m)
        # The code is mixed of kind, number of digits, length, kind of separator, whether the first one is zero, and what the gazetteer and the words before say.
        sign = F.when(m.rlike(r"[\[({]"), 0).when(m.rlike("-"), 1).when(m.rlike(r"\."), 2).otherwise(3)
        code = F.lit(kind) + 4 * (F.least(n, F.lit(20)) + 21 * (F.least(F.floor(F.length(m) / 8).cast("int"), F.lit(5)) + 6 * (sign + 4 * (m.startswith("0").cast("int") + 2 * (flags[1].cast("int") + 2 * flags[2].cast("int"))))))
        return F.struct(s.cast("int").alias("start"), F.lit(kind).alias("kind"), (s + F.length(m)).cast("int").alias("end"), vote.cast("int").alias("votes"), code.cast("int").alias("code"))

    return F.zip_with(f"s_{name}", f"m_{name}", one)


def estimate(counts: dict[tuple[int, int], int]) -> dict[tuple[int, int], float]:
    """Expectation-maximisation over (kind, votes) counts: the posterior that such a candidate is true.

    Each labeler has, by kind, a rate of yes on true and on false candidates; both begin
    with the belief that labelers beat chance, worth ten candidates, so that few data keep it.
    """
    posterior: dict[tuple[int, int], float] = {}
    n = len(LABELERS)
    belief, worth = ((0.3, 0.7),) * n, 10.0
    for kind in range(len(KINDS)):
        own = {v: c for (k, v), c in counts.items() if k == kind}
        share, rates = 0.5, [list(b) for b in belief]
        for _ in range(EM_ROUNDS):
            for v in own:
                odds = math.log(share / (1 - share))
                for i, (false, true) in enumerate(rates):
                    odds += math.log(true / false) if v >> i & 1 else math.log((1 - true) / (1 - false))
                posterior[kind, v] = 1 / (1 + math.exp(-max(-500, min(500, odds))))
            for c in (0, 1):
                weight = {v: m * (posterior[kind, v] if c else 1 - posterior[kind, v]) for v, m in own.items()}
                total = sum(weight.values())
                for i in range(n):
                    yes = sum(w for v, w in weight.items() if v >> i & 1)
                    rates[i][c] = min(0.99, max(0.01, (yes + worth * belief[i][c]) / (total + worth)))
                if c:
                    share = min(0.95, max(0.05, (total + worth / 2) / (sum(own.values()) + worth)))
            rates = [[min(f, t), max(f, t)] for f, t in rates]
    return posterior


def code_features(code: int) -> tuple[str, ...]:
    kind, rest = code % 4, code // 4
    digits, rest = rest % 21, rest // 21
    length, rest = rest % 6, rest // 6
    sign, rest = rest % 4, rest // 4
    return ("1", f"k{kind}", f"d{kind}/{digits}", f"l{kind}/{length}", f"s{kind}/{sign}", f"z{kind}/{rest % 2}", f"g{kind}/{rest // 2 % 2}", f"c{kind}/{rest // 4}")


def train(targets: dict[int, tuple[float, float]], rounds: int = 300) -> dict[int, float]:
    """A logistic classifier over one-hot features of codes from (positive, all) weights; the probability by code."""
    weights: dict[str, float] = defaultdict(float)
    total = sum(n for _, n in targets.values()) or 1.0
    for _ in range(rounds):
        slope: dict[str, float] = defaultdict(float)
        for code, (yes, n) in targets.items():
            names = code_features(code)
            p = 1 / (1 + math.exp(-sum(weights[f] for f in names)))
            for f in names:
                slope[f] += (yes - n * p) / total
        for f, g in slope.items():
            weights[f] += 2.0 * g - 1e-4 * weights[f]
    return {code: 1 / (1 + math.exp(-sum(weights[f] for f in code_features(code)))) for code in targets}


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)``, one row per row of ``docs``.

    Counts and digest are of the base spans; spans has these and the accepted
    candidates that touch none of them. A null or empty text has no span; null ids
    and repeated rows are carried; an empty table gives no row; extra columns are
    ignored. What reaches the driver is counts by (kind, votes, code), bounded by
    their product and not by rows.
    """
    staged = common.stage(with_spans(docs), "pii-spans")
    rows = staged.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.code").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[tuple[int, int], int] = defaultdict(int)
    for r in rows:
        counts[r.kind, r.votes] += r.n
    posterior = estimate(counts)
    targets: dict[int, tuple[float, float]] = {}
    for r in rows:
        yes, n = targets.get(r.code, (0.0, 0.0))
        targets[r.code] = yes + r.n * posterior[r.kind, r.votes], n + r.n
    accepted = sorted(code for code, p in train(targets).items() if p >= ACCEPT_FROM)
    codes = F.array(*map(F.lit, accepted)) if accepted else F.array().cast("array<int>")
    plain = F.filter("candidates", lambda c: F.array_contains(codes, c["code"]) & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    added = F.transform(plain, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    told = staged.withColumn("added", added)
    return told.select(
        "doc_id", *[spans.count_of(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(spans.joined(F.col("base"), KINDS).cast("binary"), 256).alias("base_sha256"), spans.joined(F.concat("base", "added"), KINDS).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document of ``documents``."""
    return find_personal_data(common.table(spark, sf_dir, "documents"))
