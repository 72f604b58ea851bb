"""Keyword splitting with built-in expressions only.

Words of alphabetic scripts are runs of letters, marks and digits. Chinese, Japanese and Korean text
has no word breaks, so its runs are looked up in a dictionary; what the dictionary does not know
comes out as it stands, so no text is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The common ideographs come first, as a range: comparing is far cheaper than asking for the script.
_COMMON = "一-龥"
_CJK = rf"{_COMMON}\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}\p{{IsHangul}}ー"
# None of these scripts starts below U+1100, so other text is passed over without asking, too.
_RUN = rf"[{_COMMON}[\x{{1100}}-\x{{10FFFF}}&&[{_CJK}]]]+"
_WORD_RUN = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{_CJK}]]+"
EITHER_RUN = rf"{_WORD_RUN}|[{_CJK}]+"
ASCII_BREAK = r"[\x00-/:-@\[-`{-\x7F]+"
_SPACED_BREAK = rf"[\x00-/:-@\[-`{{-\x7F{_COMMON}]+"
PIECE = 256


def spaced_words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits, in order, repeats kept; no CJK text."""
    return F.transform(F.regexp_extract_all(text, F.lit(_WORD_RUN), 0), F.lower)


def _ascii_only(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def _tokens(df: DataFrame, text: str, breaks: str = ASCII_BREAK, token: str = EITHER_RUN) -> DataFrame:
    """The other columns of ``df`` and ``word``: word runs and CJK runs, in their own case.

    Texts are cut at characters that belong to no word, which is cheap; only pieces with other than ASCII
    characters are searched by script.
    """
    rest = [name for name in df.columns if name != text]
    pieces = df.select(*rest, F.explode(F.split(F.col(text), breaks)).alias("__piece")).filter("__piece <> ''")
    piece = F.col("__piece")
    found = F.when(_ascii_only(piece), F.array(piece)).otherwise(F.regexp_extract_all(piece, F.lit(token), 0))
    return pieces.select(*rest, F.explode(found).alias("word"))


def _runs(df: DataFrame, text: str) -> DataFrame:
    """The other columns of ``df`` and ``run``: CJK runs. A text of ASCII alone is read once and has none."""
    rest = [name for name in df.columns if name != text]
    return df.select(*rest, F.explode(F.regexp_extract_all(F.col(text), F.lit(_RUN), 0)).alias("run"))


def _key(run: str = "run") -> Column:
    """A run of up to ``PIECE`` characters itself, a longer one's digest, which no run is equal to."""
    return F.when(F.length(run) <= PIECE, F.col(run)).otherwise(F.md5(run))


def _heads(rest: str = "rest") -> Column:
    """The first one and two characters, which is where a word of the dictionary starts."""
    one, two = F.substring(rest, 1, 1), F.substring(rest, 1, 2)
    return F.when(F.length(rest) > 1, F.array(one, two)).otherwise(F.array(one))


def _places(runs: DataFrame, longest: int) -> DataFrame:
    """``key, at, rest``: every place of a run with what follows it, as far as a word can reach.

    Runs are cut into pieces of equal length first, each with the beginning of the next one, so that
    looking at a place costs the same wherever in a run it is.
    """
    size = max(PIECE, longest)
    pieces = runs.select(_key().alias("key"), F.regexp_extract_all("run", F.lit(f"(?s).{{1,{size}}}"), 0).alias("pieces"))
    reaching = F.transform(
        "pieces",
        lambda own, i: F.struct(
            F.length(own).alias("own"),
            F.concat(own, F.substring(F.coalesce(F.get("pieces", i + 1), F.lit("")), 1, longest)).alias("text"),
        ),
    )
    each = pieces.select("key", F.posexplode(reaching).alias("number", "piece"))
    places = each.select("key", "number", "piece.text", F.explode(F.sequence(F.lit(1), F.col("piece.own"))).alias("place"))
    at = F.col("number").cast("long") * size + F.col("place")
    return places.select("key", at.alias("at"), F.expr(f"substring(text, place, {longest})").alias("rest"))


def _left_over(runs: DataFrame, spans: DataFrame, size: int = PIECE) -> DataFrame:
    """``key, word``: the stretches of a run that no span (key, at, word) covers.

    Spans are read in the order of their places with the furthest end so far; where the next one starts
    beyond it there is a gap. The text of a gap is put together from the pieces it lies in.
    """
    ends = spans.select("key", "at", (F.col("at") + F.length("word")).alias("until"))
    last = runs.select(_key().alias("key"), (F.length("run") + 1).cast("long").alias("at"))
    ends = ends.unionByName(last.withColumn("until", F.col("at")))
    before = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    gaps = ends.withColumn("start", F.coalesce(F.max("until").over(before), F.lit(1).cast("long")))
    gaps = gaps.filter("start < at").select("key", "start", F.col("at").alias("stop"))
    number = lambda c: F.expr(f"({c} - 1) div {size}")
    parts = gaps.select("*", F.explode(F.sequence(number("start"), number("stop - 1"))).alias("number"))
    pieces = runs.select(
        _key().alias("key"), F.posexplode(F.regexp_extract_all("run", F.lit(f"(?s).{{1,{size}}}"), 0)).alias("number", "text")
    ).withColumn("number", F.col("number").cast("long"))
    first = F.greatest(F.col("start") - F.col("number") * size, F.lit(1))
    length = F.least(F.col("stop") - F.col("number") * size, F.lit(size + 1)) - first
    cut = parts.join(pieces, ["key", "number"]).select(
        "key", "start", "number", F.substring("text", first.cast("int"), length.cast("int")).alias("part")
    )
    whole = cut.groupBy("key", "start").agg(F.sort_array(F.collect_list(F.struct("number", "part"))).alias("parts"))
    return whole.select("key", F.array_join("parts.part", "").alias("word"))


def _short_run_words(runs: DataFrame, known: DataFrame, longest: int) -> DataFrame:
    """``key, words`` of distinct runs of up to ``PIECE`` characters, one row per run.

    The places of a run stay where the run is, unless the dictionary has to be shuffled to them. A place
    behind the last one closes the last gap and keeps runs without any known word.
    """
    places = runs.select("run", F.explode(F.sequence(F.lit(1), F.col("chars") + 1)).alias("at"))
    places = places.select("run", "at", F.expr(f"substring(run, at, {longest})").alias("rest"))
    # The closing place has a head, too, so that those of all runs do not meet on the empty one.
    heads = F.when(F.col("rest") == "", F.array(F.substring("run", 1, 2))).otherwise(_heads())
    places = places.select("run", "at", "rest", F.explode(heads).alias("head"))
    found = places.join(known, (places["head"] == known["head"]) & F.startswith("rest", "word"), "left")
    found = found.filter("word IS NOT NULL OR rest = ''")
    span = F.struct("at", (F.col("at") + F.coalesce(F.length("word"), F.lit(0))).alias("until"), "word")
    spans = found.groupBy("run").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    read = F.aggregate(
        "spans",
        F.struct(F.lit(1).alias("reach"), F.array().cast("array<string>").alias("gaps")),
        lambda seen, s: F.struct(
            F.greatest(seen["reach"], s["until"]).alias("reach"),
            F.when(
                seen["reach"] < s["at"],
                F.concat(seen["gaps"], F.array(F.substring(F.col("run"), seen["reach"], s["at"] - seen["reach"]))),
            ).otherwise(seen["gaps"]).alias("gaps"),
        ),
    )
    return spans.select(
        _key().alias("key"), F.concat(F.filter("spans.word", lambda w: w.isNotNull()), read["gaps"]).alias("words")
    )


def words_of_runs(runs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``key, words`` of every distinct run (``run``; ``_key`` names it): every known word at every place, then
    what none of them covers. A run of up to ``PIECE`` characters has one row, a longer one a row per word.

    A place is looked up by its first one and two characters and compared over the word's own length, so
    words of any length are found. Work is linear in the length of a run. The length of the longest word
    is read from the dictionary at once.
    """
    known = dictionary.select("word").filter("word <> ''").distinct()
    longest = known.agg(F.max(F.length("word"))).first()[0] or 1
    known = known.select("word", F.substring("word", 1, 2).alias("head"))
    # The length is an aggregate, so that a filter on it stays behind the shuffle that both kinds then share.
    distinct = runs.groupBy("run").agg(F.max(F.length("run")).alias("chars"))
    short, long = distinct.filter(F.col("chars") <= PIECE), distinct.filter(F.col("chars") > PIECE)
    places = _places(long, longest).select("key", "at", "rest", F.explode(_heads()).alias("head"))
    spans = places.join(known, "head").filter(F.startswith("rest", "word")).select("key", "at", "word")
    of_long = spans.select("key", "word").unionByName(_left_over(long, spans))
    return _short_run_words(short, known, longest).unionByName(of_long.select("key", F.array("word").alias("words")))


def split_words(df: DataFrame, text: str, dictionary: DataFrame | None = None) -> DataFrame:
    """One row per word of ``text``: the other columns of ``df`` plus ``word``.

    With a ``dictionary`` (column ``word``) all its words in a CJK run come out, overlapping ones
    too, and the stretches it does not know; without one the whole run does. Each distinct run is
    looked up once. A stream has no distinct runs to look up: there, split each batch
    (``jobs.keyword_words``).
    """
    if dictionary is None:
        return _tokens(df, text).withColumn("word", F.lower("word"))
    rest = [name for name in df.columns if name != text]
    spaced = _tokens(df, text, _SPACED_BREAK, _WORD_RUN).withColumn("word", F.lower("word"))
    runs = _runs(df, text)
    looked_up = words_of_runs(runs.select("run"), dictionary)
    named = runs.select(*rest, _key().alias("__key")).join(
        looked_up.withColumnRenamed("key", "__key"), "__key"
    )
    return spaced.unionByName(named.select(*rest, F.explode("words").alias("word")))


def count_split_words(df: DataFrame, text: str, dictionary: DataFrame) -> DataFrame:
    """``split_words`` by a dictionary, counted (``ct``): one row per word and value of the other columns.

    CJK runs are counted before they become words, which are far more.
    """
    rest = [name for name in df.columns if name != text]
    spaced = _tokens(df, text, _SPACED_BREAK, _WORD_RUN).select(*rest, F.lower("word").alias("word"))
    spaced = spaced.groupBy(*rest, "word").agg(F.count(F.lit(1)).alias("ct"))
    runs = _runs(df, text).groupBy(*rest, "run").agg(F.count(F.lit(1)).alias("n"))
    # The filter, which all rows pass, keeps the count, so that looking up and naming share what was shuffled.
    looked_up = words_of_runs(runs.filter("n > 0").select("run"), dictionary).withColumnRenamed("key", "__key")
    named = runs.filter("n > 0").select(*rest, _key().alias("__key"), "n").join(looked_up, "__key")
    known = named.select(*rest, "n", F.explode("words").alias("word")).groupBy(*rest, "word").agg(F.sum("n").alias("ct"))
    # Word runs have no CJK character and CJK words nothing else, so no word is in both.
    return spaced.unionByName(known)
