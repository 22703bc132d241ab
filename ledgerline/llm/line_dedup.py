"""Removal of lines that nearly repeat an earlier one, by an exact set-similarity join.

A line's tokens are its distinct five-word shingles (all its words, if fewer). A line goes
if an earlier line, kept or not, has a Jaccard similarity of p/q = 4/5 or more; earlier is
by document, then by place.

1. Lines with the same characters are one; only the first of them is looked at further.
2. Tokens are ordered by rarity: the counts of all tokens in 4,096 hash classes, over all
   lines, rank the classes; inside a class the hash decides. Lines that are similar enough
   share one of the first n - ceil(4n/5) + 1 tokens in this order, which are indexed.
3. Lines that share such a token are compared by their numbers of tokens and by the places
   of the shared one, then by the bits their tokens set, which bound the similarity from
   above; what passes is verified.
4. In each group of a shared token, a line is first compared with the first line of the
   group and the one before it. Only lines that are not resolved this way are joined with
   the whole group. A family of variants is resolved by its first and previous members; lines
   that share a rare token without being similar are joined pair by pair.

Only column functions run. Defined results: null, empty and blank texts have no lines to
remove; lines without a word always stay. Rows that share an id are ordered by their texts'
hashes; rows that also share the text are one document. Rows without an id come last. An
empty table gives an empty result. Other columns pass through ``without_similar_lines``,
whatever their names, where only the text and, if there is one, ``n_chars`` change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACES, join_few, join_lists, keyed, stored

SHINGLE_WORDS = 5
P, Q = 4, 5  # similarity P/Q
CLASSES = 4096
BIT_WORDS = 2  # a power of two
LOW_BITS = (1 << 50) - 1
NO_HASHES = "CAST(array() AS array<bigint>)"
LINE_BITS, SIZE_BITS, PLACE_BITS = 20, 22, 21  # of line, n and place in one number; what is above them is in another


def _lines(base: DataFrame) -> DataFrame:
    """(_key, line, string) of all lines with a word."""
    split = base.select("_key", F.posexplode(F.split("text", "\n")).alias("line", "string"))
    return split.where(F.length(F.btrim("string", F.lit(SPACES))) > 0)


def _line_words(lines: DataFrame) -> DataFrame:
    """Adds the words of a line as ``_w``; blanks of all kinds become spaces, on which to split costs least."""
    spaced, rare = F.col("string"), F.lit(False)
    for blank in SPACES.strip(" "):
        rare = rare | F.contains("string", F.lit(blank))
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    gaps = "contains(_s, '  ') OR startswith(_s, ' ') OR endswith(_s, ' ')"
    words = F.expr(f"CASE WHEN {gaps} THEN array_remove(split(_s, ' '), '') ELSE split(_s, ' ') END")
    return lines.withColumn("_s", F.when(rare, spaced).otherwise(F.col("string"))).withColumn("_w", words).drop("_s")


def _with_tokens(lines: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Adds the hashes of a line's shingles, with repetitions."""
    picked = ", ".join(f"get(_w, i + {j})" for j in range(words))
    hashes = f"""CASE WHEN size(_w) < {words} THEN array(xxhash64(_w))
        ELSE transform(sequence(0, size(_w) - {words}), i -> xxhash64({picked})) END"""
    return _line_words(lines).withColumn("tokens", F.expr(hashes)).drop("_w")


def _token_rows(lines: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """The same hashes as rows (t); made after the explode they are compiled, half as dear as in an array."""
    starts = F.expr(f"explode_outer(sequence(0, greatest(size(_w) - {words}, 0)))")
    picked = ", ".join(f"_w[i + {j}]" for j in range(words))
    placed = _line_words(lines).select("_w", starts.alias("i"))
    return placed.select(F.expr(f"CASE WHEN size(_w) < {words} THEN xxhash64(_w) ELSE xxhash64({picked}) END").alias("t"))


def _class_ranks(lines: DataFrame) -> Column:
    """Rank by rarity of each hash class, as a constant array of CLASSES numbers."""
    counts = _token_rows(lines).groupBy(F.pmod("t", F.lit(CLASSES)).alias("c")).agg(F.count("*").alias("n")).collect()
    ranks = ["0"] * CLASSES
    for place, row in enumerate(sorted(counts, key=lambda r: (r["n"], r["c"]))):
        ranks[row["c"]] = str(place + 1)
    return F.split(F.lit(",".join(ranks)), ",").cast("array<bigint>")


def _packed(rows: DataFrame) -> DataFrame:
    """(token, _key, spot, more): line, n and place in one number as far as they fit, their upper bits in another."""
    return rows.select(
        "token", "_key",
        F.expr(f"""line & {(1 << LINE_BITS) - 1}L | shiftleft(n & {(1 << SIZE_BITS) - 1}L, {LINE_BITS})
            | shiftleft(place & {(1 << PLACE_BITS) - 1}L, {LINE_BITS + SIZE_BITS})""").alias("spot"),
        F.expr(f"""CAST(shiftright(line, {LINE_BITS}) AS bigint) | shiftleft(CAST(shiftright(n, {SIZE_BITS}) AS bigint), 11)
            | shiftleft(CAST(shiftright(place, {PLACE_BITS}) AS bigint), 21)""").alias("more"),
    )


def _unpacked(rows: DataFrame) -> DataFrame:
    """(token, _key, line, n, place) again."""
    places = {
        "line": f"spot & {(1 << LINE_BITS) - 1}L | shiftleft(more & 2047L, {LINE_BITS})",
        "n": f"shiftright(spot, {LINE_BITS}) & {(1 << SIZE_BITS) - 1}L | shiftleft(shiftright(more, 11) & 1023L, {SIZE_BITS})",
        "place": f"shiftright(spot, {LINE_BITS + SIZE_BITS}) | shiftleft(shiftright(more, 21), {PLACE_BITS})",
    }
    return rows.select("token", "_key", *[F.expr(f"CAST({e} AS int)").alias(c) for c, e in places.items()])


def _prefix_rows(lines: DataFrame, ranks: Column) -> DataFrame:
    """(token, _key, line, n, place) of the indexed tokens, dealt by token; place counts from 1.

    A token's sort key is its class's rank above the low bits of its hash. Should two tokens
    of a line share a key, both stay, so prefixes keep their length.
    """
    sets = _with_tokens(lines).select("_key", "line", F.array_distinct("tokens").alias("_t")).withColumn("n", F.size("_t"))
    rank = lambda t: F.get(ranks, t.bitwiseAND(F.lit(CLASSES - 1)).cast("int"))  # noqa: E731 - CLASSES is a power of two
    ordered = sets.withColumn("_o", F.sort_array(F.transform(
        "_t", lambda t: F.shiftleft(rank(t), 50).bitwiseOR(t.bitwiseAND(F.lit(LOW_BITS)))
    )))
    prefix = F.expr(f"slice(_o, 1, n - ({P} * n + {Q - 1}) DIV {Q} + 1)")
    rows = ordered.select("_key", "line", "n", F.posexplode_outer(prefix).alias("place", "token"))
    return _unpacked(_packed(rows.withColumn("place", F.col("place") + 1)).repartition("token"))


def _may_match(x: str, y: str) -> Column:
    """Bounds from the sizes and from the places of a shared token."""
    nx, ny, px, py = f"{x}n", f"{y}n", f"{x}place", f"{y}place"
    overlap = f"({P} * ({nx} + {ny}) + {P + Q - 1}) DIV {P + Q}"
    return F.expr(f"{Q} * least({nx}, {ny}) >= {P} * greatest({nx}, {ny}) "
                  f"AND 1 + least({nx} - {px}, {ny} - {py}) >= {overlap}")


def _bits(tokens: str, i: int) -> Column:
    """One number of a set's bits: those of its tokens that fall to this number, each at a place its hash gives.

    A bit in which two sets differ comes from a token in which they differ, and no token sets two.
    """
    own = lambda t: F.when(t.bitwiseAND(F.lit(BIT_WORDS - 1)) == i, F.expr("1L")).otherwise(F.expr("0L"))
    return F.aggregate(tokens, F.expr("0L"), lambda bits, t: bits.bitwiseOR(
        F.call_function("shiftleft", own(t), F.shiftright(t, 8).bitwiseAND(F.lit(63)).cast("int"))))


def _verified(pairs: DataFrame, base: DataFrame) -> DataFrame:
    """The pairs (x_key, x_line, y_key, y_line) whose token sets are similar enough."""
    pairs = stored(pairs, "line-pairs")
    ends = pairs.select(F.col("x_key").alias("_key"), F.col("x_line").alias("line")).union(pairs.select("y_key", "y_line")).distinct()
    lists = stored(ends.groupBy("_key").agg(F.collect_set("line").alias("_wanted")), "wanted-lines")
    wanted = join_lists(base, lists, "_key", "_wanted", "inner").select(
        "_key", F.explode_outer("_wanted").alias("line"), F.split("text", "\n").alias("_all")
    ).select("_key", "line", F.expr("_all[line]").alias("string"))
    found = _with_tokens(wanted).select("_key", "line", F.array_distinct("tokens").alias("t"))
    sets = stored(found.select("_key", "line", "t", F.size("t").alias("n"), *[_bits("t", i).alias(f"b{i}") for i in range(BIT_WORDS)]), "line-sets")
    side = lambda s, names: sets.select(*[F.col(c).alias(f"{s}{d}") for c, d in (("_key", "_key"), ("line", "_line"), *names)])
    small = [(c, c) for c in ("n", *[f"b{i}" for i in range(BIT_WORDS)])]
    open_pairs = pairs.join(side("x", small), ["x_key", "x_line"]).join(side("y", small), ["y_key", "y_line"])
    differ = " + ".join(f"bit_count(xb{i} ^ yb{i})" for i in range(BIT_WORDS))
    close = open_pairs.where(F.expr(f"{Q} * least(xn, yn) >= {P} * greatest(xn, yn) AND {P + Q} * ({differ}) <= {Q - P} * (xn + yn)"))
    likely = stored(close.select("x_key", "x_line", "y_key", "y_line"), "likely-pairs")
    both = likely.join(side("x", [("t", "t")]), ["x_key", "x_line"]).join(side("y", [("t", "t")]), ["y_key", "y_line"])
    both = both.withColumn("_c", F.expr("size(array_intersect(xt, yt))"))
    return both.where(F.expr(f"{Q} * _c >= {P} * (size(xt) + size(yt) - _c)")).select("x_key", "x_line", "y_key", "y_line")


def kept_lines(base: DataFrame) -> DataFrame:
    """(_key, kept): for each document with any, the places of the lines with a word that stay.

    ``base`` has (_key, text) with unique keys in the order of documents.
    """
    lines = _lines(base)
    same = lines.groupBy(F.xxhash64("string").alias("a"), F.xxhash64("string", F.lit(1)).alias("b"))
    firsts = stored(same.agg(F.min(F.struct("_key", "line")).alias("f")).select("f._key", "f.line"), "first-lines")
    lists = stored(firsts.groupBy("_key").agg(F.collect_list("line").alias("_firsts")), "first-line-lists")
    opened = join_lists(base, lists, "_key", "_firsts", "inner").select(
        "_key", F.explode_outer("_firsts").alias("line"), F.split("text", "\n").alias("_all")
    ).select("_key", "line", F.expr("_all[line]").alias("string"))
    rows = _prefix_rows(opened, _class_ranks(lines))
    groups = Window.partitionBy("token")
    in_order = groups.orderBy("_key", "line")
    me = F.struct("_key", "line", "n", "place")
    met = rows.withColumn("_m", F.count("*").over(groups)).where("_m > 1")  # most are alone, and to sort by one number costs least
    shared = stored(met.withColumn("_first", F.first(me).over(in_order)).withColumn("_last", F.lag(me).over(in_order)), "shared-tokens")
    near = shared.select(
        F.col("_key").alias("y_key"), F.col("line").alias("y_line"), F.col("n").alias("yn"), F.col("place").alias("yplace"),
        F.explode_outer(F.array("_first", "_last")).alias("x"),
    ).select("y_key", "y_line", "yn", "yplace", F.col("x._key").alias("x_key"), F.col("x.line").alias("x_line"),
             F.col("x.n").alias("xn"), F.col("x.place").alias("xplace"))
    earlier = F.expr("x_key < y_key OR (x_key = y_key AND x_line < y_line)")
    pairs = near.where(earlier & _may_match("x", "y")).select("x_key", "x_line", "y_key", "y_line").distinct()
    resolved = stored(_verified(pairs, base).select(F.col("y_key").alias("_key"), F.col("y_line").alias("line")).distinct(), "resolved-lines")

    shared = shared.where("_m > 3")  # in groups of up to three these were all pairs
    flagged = join_few(shared, resolved.withColumn("_done", F.lit(True)), ["_key", "line"], row_bytes=24, salts=1)
    open_rows = flagged.where("_done IS NULL")
    y = open_rows.select("token", F.col("_key").alias("y_key"), F.col("line").alias("y_line"), F.col("n").alias("yn"), F.col("place").alias("yplace"))
    x = shared.select("token", F.col("_key").alias("x_key"), F.col("line").alias("x_line"), F.col("n").alias("xn"), F.col("place").alias("xplace"))
    rest = y.join(x, (y["token"] == x["token"]) & earlier & _may_match("x", "y"))
    late = _verified(rest.select("x_key", "x_line", "y_key", "y_line").distinct(), base)
    gone = resolved.union(late.select("y_key", "y_line").distinct())
    return firsts.join(gone, ["_key", "line"], "left_anti").groupBy("_key").agg(F.sort_array(F.collect_list("line")).alias("kept"))


def _base(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with a key, and one (_key, text) per key."""
    rows, unique = keyed(docs)
    base = rows.select("_key", F.coalesce("text", F.lit("")).alias("text"))
    return rows, base if unique else base.dropDuplicates(["_key"])


def without_similar_lines(docs: DataFrame) -> DataFrame:
    """The table with the remaining text of each row, in the same columns."""
    rows, base = _base(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_original")))
    lists = stored(kept_lines(base), "kept-lines")
    lists = lists.withColumnRenamed("kept", "_kept")
    joined = join_lists(rows, lists, "_key", "_kept").withColumn("_all", F.split("text", "\n"))
    blank = F.expr(f"filter(sequence(0, size(_all) - 1), i -> length(btrim(_all[i], '{SPACES}')) = 0)")
    places = F.array_sort(F.array_union(blank, F.coalesce("_kept", F.expr("CAST(array() AS array<int>)"))))
    left = F.expr("array_join(transform(_places, i -> _all[i]), '\\n')")
    made = joined.withColumn("_places", places).withColumn("text", F.when(F.col("text").isNotNull(), left))
    columns = {c: F.col("_original").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)
    return made.select(*[column.alias(c) for c, column in columns.items()])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed (lines with a word), and the places of the removed lines."""
    rows, base = _base(docs)
    lists = stored(kept_lines(base), "kept-lines")
    worded = F.expr(f"filter(transform(_all, (s, i) -> IF(length(btrim(s, '{SPACES}')) > 0, i, -1)), i -> i >= 0)")
    counted = rows.select("doc_id", "_key", F.split(F.coalesce("text", F.lit("")), "\n").alias("_all")).select("doc_id", "_key", worded.alias("_w"))
    joined = join_lists(counted, lists, "_key", "kept")
    removed = F.array_except("_w", F.coalesce("kept", F.expr("CAST(array() AS array<int>)")))
    return joined.select("doc_id", F.size("_w").cast("bigint").alias("n_lines"), removed.alias("removed_lines")).select(
        "doc_id", "n_lines", F.size("removed_lines").cast("bigint").alias("n_removed"), "removed_lines"
    )


# The same in DuckDB's SQL, over ``documents``: all pairs that share a token are counted.
SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(a))) AS line, unnest(a) AS s FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
worded AS (
  SELECT doc_id, line, s, list_filter(string_split_regex(s, '[ \x09-\x0D]+'), lambda x: x <> '') AS w
  FROM lines WHERE regexp_matches(s, '[^ \x09-\x0D]')),
firsts AS (SELECT s, any_value(w) AS w, min(struct_pack(doc_id := doc_id, line := line)) AS f FROM worded GROUP BY s),
sets AS (
  SELECT s, f, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS t FROM firsts),
tokens AS (SELECT f, len(t) AS n, unnest(t) AS token FROM sets),
shared AS (
  SELECT x.f AS xf, y.f AS yf, x.n AS xn, y.n AS yn, count(*) AS c
  FROM tokens x JOIN tokens y ON x.token = y.token AND x.f < y.f GROUP BY ALL),
gone AS (SELECT DISTINCT yf AS f FROM shared WHERE 5 * c >= 4 * (xn + yn - c)),
kept AS (SELECT f.doc_id AS doc_id, f.line AS line FROM firsts WHERE f NOT IN (SELECT f FROM gone)),
removed AS (SELECT doc_id, line FROM worded EXCEPT SELECT doc_id, line FROM kept)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(len(r), 0)::BIGINT AS n_removed, coalesce(r, [])::INT[] AS removed_lines
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT doc_id, list(line ORDER BY line) AS r FROM removed GROUP BY doc_id) USING (doc_id)"""
