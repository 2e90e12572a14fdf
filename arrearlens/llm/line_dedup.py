"""Line deduplication by an exact set-similarity join, in DataFrame functions alone.

A line's tokens are its distinct runs of five words (fewer words make one run), hashed to 64 bits. Lines
match where the Jaccard similarity of their tokens is `PERCENT` or more; a line that matches an earlier
one (by doc_id, then place) is removed, and of equal lines the first stays.

A prefix filter needs one order of all tokens: two lines that match share a token among the first
n - ceil(t * n) + 1 of each. Tokens stand in the order of their rarity, so that a passage that many lines
hold comes last in each and does not bring them together: a token's level is the logarithm of how often
it occurs, counted on all lines with their repeats in counters that tokens share, and kept in a field of
fixed size, which every task has. Any order is exact; a level that is off only costs work. Among equals the hash decides. Lines
meet on the tokens that their prefixes share under length and positional bounds, then on how far their
prefixes differ, and the pairs that are left are verified on the full sets.

In a posting each line is first compared with the earliest line there. Only lines that this does not
settle are compared with every earlier line of their postings, so a line with thousands of near copies
costs each copy a few comparisons.

Defined results: null texts stay null, with 0 lines; empty texts have one line, without words. Lines
without words are never removed, and rows without an id are left as they are. Rows of the same id and
equal lines at the same place count as one occurrence, so repeated rows give repeated results. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, release, unused

SHINGLE = 5
PERCENT = 80
#: Rows of ids, hashes or places (under 100 bytes each) that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 400_000
#: The same for tables of bare 64-bit hashes (8 bytes, about 24 in a task's memory).
BROADCAST_HASHES = 3_000_000
#: Tokens of all lines together (8 bytes each) up to which the lines of a verification are broadcast.
BROADCAST_TOKENS = 4_000_000

#: Cells of the field of levels; lines that count as one, so that levels tell up to 2**19 lines apart.
CELLS, UNIT = 1 << 14, 16
#: Counters of runs, from which the levels are taken: a task passes on this many rows at most.
COUNTERS = 1 << 16
#: Levels take the highest bits of a token but the sign.
_HIGHEST, _LEVEL_BITS = 15, 4

_SPACES = r"[\x20\x09-\x0D]+"


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for a broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= rows else df


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line, lid) of all lines with a word, of rows with an id."""
    every = docs.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return every.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("lid", F.unhex(F.md5(F.col("line").cast("binary"))))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, wherever the optimiser puts it."""
    return F.transform(F.array(value), body)[0]


def _words(line: Column) -> Column:
    """A line's words; where nothing but spaces parts them, they are found without a regular expression."""
    plain = ~F.contains(line, F.lit("\t")) & ~F.contains(line, F.lit("\x0b")) & ~F.contains(line, F.lit("\x0c")) & ~F.contains(line, F.lit("\r"))
    return F.array_remove(F.when(plain, F.split(line, " ")).otherwise(F.split(line, _SPACES)), "")


def _last_run(words: Column) -> Column:
    """Where the last run of a line's words begins, from 0; fewer words than a run's make one run."""
    return F.greatest(F.size(words) - SHINGLE, F.lit(0))


def _run(words: Column, at: Column) -> list[Column]:
    """The words of a run; behind the last word null, which isn't hashed."""
    return [F.get(words, at + k) for k in range(SHINGLE)]


def run_counts(docs: DataFrame) -> DataFrame:
    """(at, n): how many runs of all lines fall into each of COUNTERS counters.

    In compiled code alone, and added up before the shuffle: a task passes on COUNTERS rows at most."""
    lines = docs.where("doc_id is not null").select(F.explode(F.split("text", "\n", -1)).alias("line"))
    words = lines.select(_words(F.col("line")).alias("words"))
    runs = words.select("words", F.explode(F.sequence(F.lit(0), _last_run(F.col("words")))).alias("at"))
    run = [F.get("words", F.col("at") + k) for k in range(SHINGLE)]
    hashed = F.xxhash64(*[F.when(word.isNotNull(), F.xxhash64(word)) for word in run])  # as in `tokens`
    return runs.where(run[0].isNotNull()).groupBy(hashed.bitwiseAND(F.lit(COUNTERS - 1)).alias("at")).agg(F.count("*").alias("n"))


def levels(docs: DataFrame) -> Column:
    """An array of CELLS levels: how common tokens are, as a power of two of the places that hold them, less what
    a counter holds on average.

    It stands in the plan as a literal, so it is kept short."""
    of_cell = run_counts(docs).groupBy(F.col("at").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).agg(F.max("n").alias("most"), F.sum("n").alias("runs"))
    rows = of_cell.collect()  # CELLS rows of three numbers at most
    chance = sum(r.runs for r in rows) // COUNTERS
    found = [0] * CELLS
    for r in rows:
        found[r.cell] = min(_HIGHEST, max(1, (r.most - chance) // UNIT).bit_length() - 1)
    del of_cell
    release(docs.sparkSession)
    return F.from_json(F.lit(str(found).replace(" ", "")), "array<bigint>")


def tokens(line: Column, common: Column) -> Column:
    """The distinct hashed runs of a line's words, the rarest first: a token is its level, then 59 bits of its hash."""

    def runs(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), _last_run(hashes)), lambda at: F.xxhash64(*_run(hashes, at)))

    def ranked(token: Column) -> Column:
        level = F.get(common, token.bitwiseAND(F.lit(CELLS - 1)).cast("int"))
        return F.shiftleft(level, 63 - _LEVEL_BITS).bitwiseOR(F.shiftrightunsigned(token, 1 + _LEVEL_BITS))

    hashed = _let(F.transform(_words(line), lambda word: F.xxhash64(word)), runs)
    return F.sort_array(F.array_distinct(F.transform(hashed, ranked)))


def _prefix_length(n: Column, similar: int) -> Column:
    return n - F.ceil(n * similar / 100) + 1


def _occurrences(docs: DataFrame, similar: int, common: Column) -> DataFrame:
    """(lid, doc_id, pos, n, prefix) of every line with a word: the only pass over all words."""
    seen = _lines(docs).withColumn("tokens", tokens(F.col("line"), common))
    n = F.size("tokens")
    return seen.select("lid", "doc_id", "pos", n.alias("n"), F.slice("tokens", F.lit(1), _prefix_length(n, similar).cast("int")).alias("prefix"))


def _met(seen: DataFrame) -> DataFrame:
    """(line, token) of prefix tokens that two different lines or more have; others lead nowhere.

    Tokens seen twice are found from tokens and counts alone; only their rows carry a hash of the line.
    """
    again = seen.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    posted = seen.select(F.xxhash64("lid").alias("line"), F.explode("prefix").alias("token")).join(_small(cut(again), BROADCAST_HASHES), "token")
    rows = cut(posted.distinct())
    del again, posted
    release(seen.sparkSession)
    shared = rows.groupBy("token").agg(F.count("*").alias("lines")).where("lines > 1").select("token")
    return rows.join(shared, "token").select("line", "token")


def _sets(docs: DataFrame, wanted: DataFrame, common: Column) -> DataFrame:
    """(lid, tokens) of wanted lines (lid, first), from the first place of each."""
    places = wanted.groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_list(F.struct("first.pos", "lid")).alias("places"))
    rows = docs.join(_small(cut(places)), "doc_id").select(F.split("text", "\n", -1).alias("lines"), F.explode("places").alias("place"))
    rows = rows.select("place.lid", F.get("lines", F.col("place.pos")).alias("line"))
    rows = rows.where(F.unhex(F.md5(F.col("line").cast("binary"))) == F.col("lid"))  # an id may have several texts
    return rows.select("lid", tokens(F.col("line"), common).alias("tokens"))


def _least_common(similar: int) -> Column:
    """Tokens that the prefixes of two lines of n and e_n tokens share at least if the lines match.

    The prefix that ends first lies within what is known of both lines, and of its tokens the other line
    lacks no more than it may lack in all.
    """
    n, m = F.col("n"), F.col("e_n")
    wanted = F.ceil((n + m) * similar / (100 + similar))
    return F.least(_prefix_length(n, similar) - n + wanted, _prefix_length(m, similar) - m + wanted)


def _may_match(similar: int) -> Column:
    """Length, positional and prefix bounds for two postings under one token.

    Two lines share no more of their prefixes than either has tokens that any two lines share (s): with
    many tokens of its own in the prefix, a line is out.
    """
    n, m, i, j = (F.col(c) for c in ("n", "e_n", "at", "e_at"))
    lengths = F.least(n, m) * 100 >= F.greatest(n, m) * similar
    # common tokens wanted: t / (1 + t) of both sizes; before and behind a common token there is only so much room
    wanted = F.ceil((n + m) * similar / (100 + similar))
    positions = F.least(i, j) + F.least(n - i, m - j) >= wanted
    return lengths & positions & (F.least("s", "e_s") >= _least_common(similar))


def _promising(pairs: DataFrame, prefixes: DataFrame, similar: int) -> DataFrame:
    """Pairs whose prefixes don't differ too much already.

    Up to where the shorter prefix ends both lines' tokens are known; those that only one of them has
    there are in the symmetric difference, of which a match has at most (1 - t) / (1 + t) of both sizes.
    """
    one = prefixes.select("lid", "n", F.col("prefix").alias("p"))
    other = prefixes.select(F.col("lid").alias("e_lid"), F.col("n").alias("e_n"), F.col("prefix").alias("e_p"))
    both = pairs.join(one, "lid").join(other, "e_lid")
    end = F.least(F.element_at("p", -1), F.element_at("e_p", -1))
    known = F.size(F.filter("p", lambda t: t <= end)) + F.size(F.filter("e_p", lambda t: t <= end))
    apart = known - 2 * F.size(F.array_intersect("p", "e_p"))
    return both.where(apart * (100 + similar) <= (F.col("n") + F.col("e_n")) * (100 - similar)).select("lid", "e_lid")


def _verified(docs: DataFrame, pairs: DataFrame, prefixes: DataFrame, similar: int, levels_: Column) -> DataFrame:
    """(lid) of the pairs (lid, e_lid) that match on their full sets."""
    pairs = cut(_promising(pairs, prefixes, similar))
    lids = pairs.select("lid").unionAll(pairs.select("e_lid")).distinct()
    sets = cut(_sets(docs, prefixes.select("lid", "first").join(lids, "lid", "left_semi"), levels_))
    if (sets.agg(F.sum(F.size("tokens"))).first()[0] or 0) <= BROADCAST_TOKENS:
        sets = F.broadcast(sets)
    one = sets.select("lid", F.col("tokens").alias("t"))
    other = sets.select(F.col("lid").alias("e_lid"), F.col("tokens").alias("e_t"))
    both = pairs.join(one, "lid").join(other, "e_lid")
    common = F.size(F.array_intersect("t", "e_t"))
    match = common * 100 >= (F.size("t") + F.size("e_t") - common) * similar
    return both.where(match).select("lid").distinct()


def removed_lines(docs: DataFrame, similar: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All distinct lines (lid, first, many), and those (lid) that match an earlier one."""
    common = levels(docs)
    seen = cut(_occurrences(docs, similar, common))
    place = F.struct("doc_id", "pos")
    distinct = cut(seen.groupBy("lid").agg(F.min(place).alias("first"), (F.min(place) != F.max(place)).alias("many")))
    met = cut(_met(seen))
    release(docs.sparkSession)
    lines = _small(cut(met.select("line").distinct()), BROADCAST_HASHES)
    own = seen.withColumn("line", F.xxhash64("lid")).join(lines, "line", "left_semi").dropDuplicates(["lid"])
    prefixes = cut(own.select("lid", "n", "prefix").join(distinct.select("lid", "first"), "lid"))
    del seen, own, lines
    release(docs.sparkSession)
    every = prefixes.select("lid", "first", "n", F.posexplode("prefix").alias("at", "token")).withColumn("at", F.col("at") + 1)
    every = every.join(_small(cut(met.select("token").distinct()), BROADCAST_HASHES), "token")
    postings = cut(every.withColumn("s", F.count("*").over(Window.partitionBy("lid"))).select("token", "lid", "first", "n", "at", "s"))
    del every, met
    release(docs.sparkSession)
    earliest = postings.groupBy("token").agg(F.min(F.struct("first", "lid", "n", "at", "s")).alias("e"))
    earliest = earliest.select("token", *[F.col(f"e.{c}").alias(f"e_{c}") for c in ("first", "lid", "n", "at", "s")])
    meet = postings.join(earliest, "token").where((F.col("e_first") < F.col("first")) & _may_match(similar))
    tried = cut(meet.select("lid", "e_lid").distinct())
    settled = cut(_verified(docs, tried, prefixes, similar, common))
    del earliest, meet
    release(docs.sparkSession)
    unsettled = postings.join(settled, "lid", "left_anti")
    others = postings.select(F.col("token").alias("e_token"), *[F.col(c).alias(f"e_{c}") for c in ("first", "lid", "n", "at", "s")])
    bounds = (F.col("token") == F.col("e_token")) & (F.col("e_first") < F.col("first")) & _may_match(similar)
    # two lines meet once under each token that their prefixes share, so the rows of a pair count these
    met_again = unsettled.join(others, bounds).groupBy("lid", "e_lid", "n", "e_n").agg(F.count("*").alias("c"))
    further = met_again.where(F.col("c") >= _least_common(similar)).select("lid", "e_lid").join(tried, ["lid", "e_lid"], "left_anti")
    more = _verified(docs, cut(further), prefixes, similar, common)
    removed = cut(settled.unionAll(more))
    del postings, prefixes, unsettled, others, met_again, further, tried, settled, more
    release(docs.sparkSession)
    return distinct, removed


def dedup_lines(docs: DataFrame, into: str = "kept_text", similar: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs`; in column `into` the text without removed lines, in `<into>_removed` their number."""
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    drop_id, drops_, left_ = unused(docs, "_drop_id", "_drops", "_left")
    distinct, removed = removed_lines(plain, similar)
    doubtful = distinct.join(_small(removed).withColumn("gone", F.lit(True)), "lid", "left").where("many or gone").select("lid", "first", F.coalesce("gone", F.lit(False)).alias("gone"))
    places = _lines(plain).select("doc_id", "pos", "lid").join(_small(cut(doubtful)), "lid")
    places = places.where(F.col("gone") | (F.struct("doc_id", "pos") != F.col("first")))
    drops = places.groupBy(F.col("doc_id").alias(drop_id)).agg(F.collect_set(F.struct("pos", "lid")).alias(drops_))
    rows = docs.join(_small(cut(drops)), docs[id_col] == F.col(drop_id), "left")
    text = F.col(f"`{text_col}`").cast("string")
    line_id = lambda x: F.unhex(F.md5(x.cast("binary")))
    left = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(drops_, F.struct(i.alias("pos"), line_id(x).alias("lid"))))
    n_lines = lambda t: F.when(t.isNull(), 0).otherwise(F.size(F.split(t, "\n", -1)))
    rows = rows.withColumn(left_, F.when(F.col(drops_).isNotNull(), left))
    out = rows.withColumn(into, F.when(F.col(left_).isNotNull(), F.array_join(left_, "\n")).otherwise(text))
    out = out.withColumn(f"{into}_removed", F.when(F.col(left_).isNotNull(), n_lines(text) - F.size(left_)).otherwise(0))
    return out.drop(drop_id, drops_, left_)


def line_counts(docs: DataFrame, similar: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, kept_sha256."""
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = dedup_lines(plain, "kept", similar)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    return rows.select("doc_id", n_lines.cast("long").alias("n_lines"), F.col("kept_removed").cast("long").alias("n_removed"), F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
