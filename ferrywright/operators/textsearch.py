"""Text search as joins over inverted tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrywright.functions.cleaning import unaccent
from ferrywright.scratch import checkpoint


def words(column: Column, plain: bool = True) -> Column:
    """Lower-case words without accents."""
    return F.filter(F.split(unaccent(column) if plain else F.lower(column), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def fts_index(df: DataFrame, id: str, columns: Sequence[str]) -> DataFrame:
    """``(word, id, weight, n)``: an inverted index; earlier columns weigh more (1, 1/2, 1/3, ..)."""
    parts = None
    for i, c in enumerate(columns):
        rows = df.select(F.explode(words(F.col(c))).alias("word"), F.col(id).alias("id"), F.lit(1.0 / (i + 1)).alias("weight"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts.groupBy("word", "id", "weight").agg(F.count(F.lit(1)).alias("n"))


def fts_search(index: DataFrame, query: str, all_words: bool = True) -> DataFrame:
    """``(id, rank)`` of rows with the words of a query. The query's words reach the index as a filter."""
    import re

    terms = sorted({w for w in re.split(r"[^\w]+", query.lower()) if w})
    plain = index.sparkSession.range(1).select(F.explode(words(F.lit(" ".join(terms)))).alias("word")).distinct() if terms else None
    if plain is None:
        return index.limit(0).select("id", F.lit(0.0).alias("rank"))
    wanted = [r.word for r in plain.collect()]
    hits = index.where(F.col("word").isin(*wanted)).groupBy("id").agg(F.sum(F.col("weight") * F.col("n")).alias("rank"), F.count_distinct("word").alias("_w"))
    return hits.where(F.col("_w") >= (len(wanted) if all_words else 1)).select("id", "rank")


def position_index(df: DataFrame, id: str, columns: Sequence[str]) -> DataFrame:
    """``(word, id, n, positions)``: an inverted index with the sorted places of each word in a row's columns, one behind the other."""
    text = F.concat_ws(" ", *columns)
    places = df.select(F.col(id).alias("id"), F.posexplode(words(text)).alias("position", "word"))
    return places.groupBy("word", "id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("position")).alias("positions"))


def _ranked_words(index: DataFrame, wanted: Column, total: int) -> DataFrame:
    """Postings of the wanted words with ``weight``: how often the row has the word, times the square of its rarity."""
    hits = index.where(wanted)
    held = hits.groupBy("word").agg(F.count(F.lit(1)).alias("_held"))
    # A word that all rows have is nearly, not quite, without weight.
    rarity = F.when(F.col("_held") >= total, F.log10(F.lit(1.0001))).otherwise(F.log10(F.lit(float(total)) / F.col("_held")))
    # A row per word of the query, or per word that one of its prefixes has.
    return hits.join(held, "word").withColumn("weight", F.col("n") * rarity * rarity)


def _plain(spark, texts: Sequence[str]) -> list[list[str]]:
    """The words of query parts, folded as the index folds its texts."""
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", words(F.col("t")).alias("w")).collect() if texts else []
    found = {r.i: r.w for r in rows}
    return [found[i] for i in range(len(texts))]


def match_natural(index: DataFrame, query: str, total: int) -> DataFrame:
    """``MATCH .. AGAINST (query)``: ``(id, rank)`` of the rows that have any of the words; ``total`` is the number of rows indexed."""
    wanted = sorted(set(_plain(index.sparkSession, [query])[0]))
    return _ranked_words(index, F.col("word").isin(*wanted), total).groupBy("id").agg(F.sum("weight").alias("rank"))


def match_boolean(index: DataFrame, query: str, total: int) -> DataFrame:
    """``MATCH .. AGAINST (query IN BOOLEAN MODE)``: ``(id, rank)``.

    ``+part`` must be there and ``-part`` must not, other parts only add to the rank; without any ``+part`` one of them must be there. A part is a word, ``word*``
    for a beginning, or ``"some words"`` for a phrase, which is found by the places of its words. A query of nothing but ``-part`` finds nothing.
    """
    import re

    found = re.findall(r'([+-]?)(?:"([^"]*)"|([^\s"]+))', query)
    folded = _plain(index.sparkSession, [phrase or word for _, phrase, word in found])
    parts = []
    for (sign, phrase, word), own in zip(found, folded, strict=True):
        if own:
            # A word with signs inside is read as a phrase of its pieces.
            parts.append((sign, own, bool(word) and word.endswith("*") and len(own) == 1))
    if not any(sign != "-" for sign, _, _ in parts):
        return index.select("id", F.lit(0.0).alias("rank")).limit(0)
    single = sorted({w for _, own, prefix in parts if not prefix for w in own})
    heads = sorted({own[0] for _, own, prefix in parts if prefix})
    wanted = F.col("word").isin(*single) if single else F.lit(False)
    for head in heads:
        wanted = wanted | F.col("word").startswith(head)
    postings = _ranked_words(index, wanted, total)
    columns = {f"p_{i}": F.max(F.when(F.col("word") == w, F.col("positions"))) for i, w in enumerate(single)}
    columns |= {f"w_{i}": F.coalesce(F.sum(F.when(F.col("word") == w, F.col("weight"))), F.lit(0.0)) for i, w in enumerate(single)}
    columns |= {f"h_{i}": F.sum(F.when(F.col("word").startswith(head), F.col("weight"))) for i, head in enumerate(heads)}
    # A row per id: as many places as the query has words.
    rows = postings.groupBy("id").agg(*[c.alias(n) for n, c in columns.items()])

    def moved(places: Column, step: int) -> Column:
        return F.transform(places, lambda at: at - step)

    def has(own: list[str], prefix: bool) -> Column:
        if prefix:
            return F.col(f"h_{heads.index(own[0])}").isNotNull()
        starts = F.col(f"p_{single.index(own[0])}")
        for step, w in enumerate(own[1:], 1):
            starts = F.array_intersect(starts, moved(F.col(f"p_{single.index(w)}"), step))
        return F.coalesce(F.size(starts) > 0, F.lit(False))

    def weight(own: list[str], prefix: bool) -> Column:
        total_weight = F.col(f"h_{heads.index(own[0])}") if prefix else sum((F.col(f"w_{single.index(w)}") for w in own), F.lit(0.0))
        return F.when(has(own, prefix), total_weight).otherwise(0.0)

    must = [has(own, prefix) for sign, own, prefix in parts if sign == "+"]
    never = [has(own, prefix) for sign, own, prefix in parts if sign == "-"]
    any_of = [has(own, prefix) for sign, own, prefix in parts if sign == ""]
    test = F.lit(True)
    for c in must:
        test = test & c
    for c in never:
        test = test & ~c
    if not must:
        some = F.lit(False)
        for c in any_of:
            some = some | c
        test = test & some
    rank = sum((weight(own, prefix) for sign, own, prefix in parts if sign != "-"), F.lit(0.0))
    return rows.where(test).select("id", rank.alias("rank"))


def _padded(column: Column) -> Column:
    """A text as trigrams see it: without accents, two spaces in front and one behind."""
    return F.concat(F.lit("  "), unaccent(column), F.lit(" "))


def trigrams(column: Column) -> Column:
    """The distinct trigrams of a text, padded with two spaces in front and one behind."""
    # An array of one element binds the letters once; a lambda's body is computed anew for each trigram.
    letters = F.filter(F.array(F.split(_padded(column), "")), lambda x: x.isNotNull())
    grams = F.transform(letters, lambda x: F.transform(F.sequence(F.lit(1), F.size(x) - 2), lambda i: F.array_join(F.slice(x, i, 3), "")))
    return F.array_distinct(F.get(grams, 0))


def _gram_table(df: DataFrame) -> DataFrame:
    """``(key, text, grams, n)`` of the distinct texts, computed once: trigrams as numbers of three code points, exact and quick to compare."""
    codes = df.where("text is not null").select("text").distinct().withColumn("_codes", F.transform(F.split(_padded(F.col("text")), ""), lambda c: F.ascii(c).cast("long")))
    pack = lambda i: F.shiftleft(F.get("_codes", i), 42) + F.shiftleft(F.get("_codes", i + 1), 21) + F.get("_codes", i + 2)
    grams = codes.withColumn("grams", F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("_codes") - 3), pack)))
    return checkpoint(grams.select(F.monotonically_increasing_id().alias("key"), "text", "grams", F.size("grams").alias("n")))


#: Longs of the bitmaps of trigrams that part most pairs before they are made distinct, and rows of a list of one trigram that are held at once.
BITMAP = 4
LIST_SHARD = 4096


def _rarest(grams: DataFrame, counts: DataFrame, name: str, key: str, threshold: float) -> DataFrame:
    """``(key, n, place, first, g, m0 ..)``: the rarest trigrams of each text, as many as it may have to be asked for by; ``first`` are those that a text needs against larger ones."""
    own = Window.partitionBy("key")
    bit = F.expr("shiftleft(1L, cast(pmod(shiftrightunsigned(_hash, 8), 64) as int))")
    maps = {f"m{i}": F.bit_or(F.when(F.pmod("_hash", F.lit(BITMAP)) == i, bit).otherwise(F.lit(0).cast("long"))).over(own) for i in range(BITMAP)}
    placed = grams.select(F.col(f"{name}_{key}").alias("key"), F.col(f"{name}_n").cast("long").alias("n"), "g").join(counts, "g").withColumn("_hash", F.xxhash64("g")).withColumns({"place": F.row_number().over(own.orderBy("_held", "g")), **maps})
    left_after = lambda share: F.col("n") - F.greatest(F.lit(1), F.ceil(F.col("n") * share - 1e-9)) + 1
    first = F.col("place") <= left_after(2 * threshold / (1 + threshold))
    return checkpoint(placed.where(F.col("place") <= left_after(threshold)).select("key", "n", "place", first.alias("first"), "g", *maps))


def _meet(smaller: DataFrame, larger: DataFrame, threshold: float, order: Column) -> DataFrame:
    """``(s_key, s_n, l_key, l_n)``, each pair once, of the pairs of which the rarest trigrams meet, by the ``order`` of their sizes, and which their bitmaps do not part."""
    listed = smaller.where("first")
    lists = listed.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / LIST_SHARD).alias("_shards"))
    names = lambda side: [F.col(c).alias(f"{side}_{c}") for c in ("key", "n", "place", *[f"m{i}" for i in range(BITMAP)])]
    # A long list is cut into shards, each of which all that ask for its trigram see.
    left = listed.join(lists, "g").select("g", F.pmod(F.xxhash64("key"), "_shards").alias("_shard"), *names("s"))
    right = larger.join(lists, "g").select("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shards") - 1)).alias("_shard"), *names("l"))
    at_most = 1 + F.least(F.col("s_n") - F.col("s_place"), F.col("l_n") - F.col("l_place"))
    reach = at_most >= (F.col("s_n") + F.col("l_n")) * (threshold / (1 + threshold)) - 1e-6
    # Each bit in which two bitmaps differ is a trigram that one text alone has.
    apart = sum((F.bit_count(F.col(f"s_m{i}").bitwiseXOR(F.col(f"l_m{i}"))) for i in range(BITMAP)), F.lit(0))
    near = apart <= (F.col("s_n") + F.col("l_n")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    sizes = F.col("s_n") >= F.col("l_n") * threshold - 1e-9
    return right.join(left, ["g", "_shard"]).where(order & sizes & reach & near).select("s_key", "s_n", "l_key", "l_n").distinct()


def trigram_candidates(left: DataFrame, right: DataFrame, threshold: float, key: str = "text") -> DataFrame:
    """``(a_<key>, b_<key>, a_n, b_n)`` of the pairs that can be alike, of ``(a_<key>, a_n, g)`` and ``(b_<key>, b_n, g)`` tables.

    Texts of a similarity of ``threshold`` share that part of each one's trigrams at least, and of the smaller one's still more, so one of
    the trigrams before them is shared too, if all are in one order. The rarest ones come first. What is left
    behind the first shared one on either side bounds how many can be shared; that and bitmaps part most pairs where they meet, before they are
    shuffled. If ``right`` is ``left`` each pair is given once, the lesser key first.
    """
    names = [f"a_{key}", f"b_{key}", "a_n", "b_n"]
    if right is left:
        counts = left.groupBy("g").agg(F.count(F.lit(1)).alias("_held"))
        own = _rarest(left, counts, "a", key, threshold)
        found = _meet(own, own, threshold, (F.col("s_n") < F.col("l_n")) | (F.col("s_n") == F.col("l_n")) & (F.col("s_key") <= F.col("l_key")))
        sides = [F.struct(F.col(f"{x}_key").alias("key"), F.col(f"{x}_n").alias("n")) for x in "sl"]
        return found.select(F.least(*sides).alias("a"), F.greatest(*sides).alias("b")).select("a.key", "b.key", "a.n", "b.n").toDF(*names)
    counts = left.select("g").unionAll(right.select("g")).groupBy("g").agg(F.count(F.lit(1)).alias("_held"))
    a, b = _rarest(left, counts, "a", key, threshold), _rarest(right, counts, "b", key, threshold)
    up, down = _meet(a, b, threshold, F.col("s_n") <= F.col("l_n")), _meet(b, a, threshold, F.col("s_n") < F.col("l_n"))
    return up.select("s_key", "l_key", "s_n", "l_n").toDF(*names).unionAll(down.select("l_key", "s_key", "l_n", "s_n").toDF(*names))


def trigram_join(a: DataFrame, b: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``(a_id, b_id, similarity)`` of ``(id, text)`` tables: shared trigrams over all of both, of pairs that share any.

    Only pairs that share one of their rarest trigrams are compared, by which no link is lost. Both sides are first made distinct by text,
    so that many rows of one text cost no more than one; trigrams are computed once per text, and ids are joined back. Of one table
    with itself (``b`` is ``a``) each pair is compared once and given both ways.
    """
    same = a is b
    left = _gram_table(a)
    right = left if same else _gram_table(b)
    grams = {k: df.select(F.col("key").alias(f"{k}_key"), F.col("n").alias(f"{k}_n"), F.explode("grams").alias("g")) for k, df in (("a", left), ("b", right))}
    sets = {k: df.select(F.col("key").alias(f"{k}_key"), F.col("grams").alias(f"{k}_grams")) for k, df in (("a", left), ("b", right))}
    pairs = trigram_candidates(grams["a"], grams["a"] if same else grams["b"], threshold, "key")
    n = F.size(F.array_intersect("a_grams", "b_grams"))
    # Counted before the filter, on rows of their own, so that no step computes it again.
    shared = pairs.join(sets["a"], "a_key").join(sets["b"], "b_key").select("a_key", "b_key", "a_n", "b_n", n.alias("n"))
    similarity = F.col("n") / (F.col("a_n") + F.col("b_n") - F.col("n"))
    alike = shared.withColumn("similarity", similarity).where(F.col("similarity") >= threshold).select("a_key", "b_key", "similarity")
    if same:
        mirror = F.when(F.col("a_key") == F.col("b_key"), F.array(F.struct("a_key", "b_key"))).otherwise(F.array(F.struct("a_key", "b_key"), F.struct(F.col("b_key").alias("a_key"), F.col("a_key").alias("b_key"))))
        alike = alike.select("similarity", F.inline(mirror))
    ids = {k: df.join(known.select("key", "text"), "text").select(F.col("id").alias(f"{k}_id"), F.col("key").alias(f"{k}_key")) for k, df, known in (("a", a, left), ("b", b, right))}
    return alike.join(ids["a"], "a_key").join(ids["b"], "b_key").select("a_id", "b_id", "similarity")
