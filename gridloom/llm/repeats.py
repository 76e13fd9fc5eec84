"""Removal of repeated runs of words by winnowing.

Every run of ``RUN`` words that stands at an earlier place too, in (id, text, place) order, is
deleted word by word, wherever in a line it begins or ends. Words are blank-separated parts;
in scripts without blanks each character is one.

Of every ``WINDOW`` neighbouring words that with the least hash is selected, and the ``GRAM``
words from there are its gram. Two places that share ``GRAM + WINDOW - 1`` = ``RUN`` words share
a selected gram. Grams that repeat are joined with their places, and each match is extended both
ways in two steps. All words that a run around the gram can reach are its context: where the
first place of a context lies in another document, its later places go whole, in one row each.
What is left are the ends of common passages, where the first places of a gram's different
contexts meet, and texts that repeat themselves; there the runs around a gram are compared one
by one, each with the first of the same words, so a frequent short quote cannot hide a longer
run. The result is that of a comparison of all pairs of places.

DataFrame operations only. Groups are never gathered: a run that a third of all documents
share is one partially aggregated row and the short side of a join. What a step has staged goes
as soon as the next one is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import apart, release, staged, unstage

RUN, GRAM, WINDOW = 28, 13, 16
BLANKS = " \n\t"
#: A line ends after each of these.
LINE_ENDS = (". ", "! ", "? ", "… ", "\n", "。", "！", "？")
MARK = "\x01"
#: Thai to Lao, Burmese, Khmer, Chinese and Japanese.
UNSPACED = "฀-໿က-႟ក-៿⺀-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff"
PLACE = (1 << 31) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _n_lines(text: Column) -> Column:
    """The lines of a text, each with its end: no two ends share a character, so the ends are counted by
    the bytes that go without them, and what follows the last one is a line too."""

    def ends(of: list[str]) -> Column:
        counts = [(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(e), F.lit("")))) / len(e.encode()) for e in of]
        return sum(counts[1:], counts[0]).cast("int")

    ascii_ends, others = ([e for e in LINE_ENDS if e.isascii() == kind] for kind in (True, False))
    closed = F.lit(False)
    for end in LINE_ENDS:
        closed = closed | F.endswith(text, F.lit(end))
    more = F.when(F.octet_length(text) > F.char_length(text), ends(others)).otherwise(0)
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(ends(ascii_ends) + more + F.when(closed, 0).otherwise(1))


def _tokens(text: Column) -> Column:
    """The words with the blank after them; a further blank stands alone."""
    marked = text
    for blank in BLANKS:
        marked = F.replace(marked, F.lit(blank), F.lit(blank + MARK))
    slow = F.split(text, f"(?<=[{BLANKS}{UNSPACED}])|(?=[{UNSPACED}])")
    unlike = F.contains(text, F.lit(MARK)) | _unspaced(text)
    return F.array_remove(F.when(unlike, slow).otherwise(F.split(marked, MARK)), "")


def _unspaced(text: Column) -> Column:
    """Whether the text holds characters of scripts without blanks. They take three bytes, so most texts
    are told by their length; one range is looked for faster than many."""
    may = F.octet_length(text) >= F.char_length(text) + 2
    return may & text.rlike(f"[{UNSPACED[0]}-\U0010ffff]") & text.rlike(f"[{UNSPACED}]")


def _bare(token: Column) -> Column:
    return F.translate(token, BLANKS, "")


def _words(text: Column) -> Column:
    """The words; a text of none has one empty word."""
    inner = F.btrim(text, F.lit(BLANKS))
    unspaced = F.filter(F.transform(_tokens(text), _bare), lambda w: w != "")
    return F.when(_unspaced(text), unspaced).otherwise(F.split(inner, f"[{BLANKS}]+"))


def _hashed(texts: DataFrame, *more: str | Column) -> DataFrame:
    """``texts`` with ``_h``, the hashes of their words. Words are read here only; grams, contexts and runs
    are slices of hashes, taken row by row where Spark compiles them."""
    return texts.select("_id", "_key", F.transform(_words(F.col("_text")), lambda w: F.xxhash64(w)).alias("_h"), *more)


def _hash(start: Column, count: Column | int) -> Column:
    return F.xxhash64(F.slice("_h", start + 1, F.lit(count) if isinstance(count, int) else count))


def _selected(hashed: DataFrame) -> DataFrame:
    """``_id``, ``_key``, ``gram``, ``context``, ``at`` and ``b`` of the selected places of texts of ``RUN`` words or more.

    A window selects its first least hash. It selects another place than the window before it if
    among the words of both that hash stands in the first place, which it leaves, or the last,
    which it enters: one row for each place, without a comparison of windows. The context is what
    the runs around a gram can reach, from ``_start(at)`` to before ``b``.
    """
    size, i, at = F.size("_h"), F.col("_i"), F.col("at")
    # A filter on the size alone would be moved below, and hash the words twice.
    windows = hashed.select("_id", "_key", "_h", F.explode(F.sequence(F.lit(0), F.greatest(size - RUN, F.lit(0)))).alias("_i"))
    both = F.slice("_h", F.greatest(i, F.lit(1)), F.lit(WINDOW + 1))
    changed = (i == 0) | F.array_position(both, F.array_min(both)).isin(1, WINDOW + 1)
    window = F.slice("_h", i + 1, F.lit(WINDOW))
    places = windows.filter((i + RUN <= size) & changed).select(
        "_id", "_key", "_h", (i + F.array_position(window, F.array_min(window)).cast("int") - 1).alias("at")
    )
    a, b = _start(at), F.least(at + RUN, size)
    return places.select(
        "_id", "_key", _hash(at, GRAM).alias("gram"), F.xxhash64(at - a, _hash(a, b - a)).alias("context"), "at", b.alias("b")
    )


def _start(at: Column) -> Column:
    return F.greatest(at - (WINDOW - 1), F.lit(0))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_key`` (hash of the text) and ``_ranges``: the words to delete, from ``a`` to before ``b``."""
    texts = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("_id"), F.xxhash64(text_col).alias("_key"), F.col(text_col).alias("_text")
    )
    grams = staged(_selected(_hashed(texts)), "grams")
    repeated = staged(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("gram"), "repeated")
    release(docs.sparkSession)
    around = staged(grams.join(repeated, "gram"), "around")
    unstage(grams, repeated)
    marked = staged(_marked(around), "marked")
    unstage(around)

    ends = marked.filter("_whole IS NULL").groupBy("_id", "_key").agg(F.collect_set("at").alias("_ends"))
    starts = F.transform("_ends", lambda at: F.sequence(_start(at), F.least(at, F.size("_h") - RUN)))
    held = _hashed(texts.join(ends, ["_id", "_key"]), "_ends").select("_id", "_key", "_h", F.array_distinct(F.flatten(starts)).alias("_starts"))
    # Of a bare column Spark would infer that it is not empty, and test that below, on words hashed anew.
    starts = held.select("_id", "_key", "_h", F.explode(F.sort_array("_starts")).alias("at"))
    runs = staged(starts.select("_id", "_key", _hash(F.col("at"), RUN).alias("run"), "at"), "runs")
    firsts = runs.groupBy("run").agg(F.min(_place()).alias("_first"), F.max(_place()).alias("_last")).filter("_first <> _last")
    firsts = staged(firsts.drop("_last"), "firsts")
    # The shuffle of the texts goes only now: that of the last job is still held.
    release(docs.sparkSession)
    later = runs.join(firsts, "run").filter(_place() != F.col("_first"))
    # A copy that overlaps its own first leaves that whole.
    start = F.when(_own(), F.greatest("at", F.col("_first.at") + RUN)).otherwise(F.col("at"))
    single = later.select("_id", "_key", _range(start, F.col("at") + RUN).alias("_range"))
    whole = marked.filter("_whole IS NOT NULL").select("_id", "_key", F.col("_whole").alias("_range"))
    ranges = single.unionByName(whole).groupBy("_id", "_key").agg(F.sort_array(F.collect_set("_range")).alias("_ranges"))
    ends = lambda r: F.struct(F.shiftright(r, 31).cast("int").alias("b"), r.bitwiseAND(F.lit(PLACE)).cast("int").alias("a"))
    return ranges.withColumn("_ranges", F.transform("_ranges", ends))


def _range(a: Column, b: Column) -> Column:
    """A stretch in one number, in order of its end; sets of those take less than sets of structs."""
    return F.shiftleft(b.cast("bigint"), 31).bitwiseOR(a.cast("bigint"))


def _place() -> Column:
    return F.struct("_id", "_key", "at")


def _own() -> Column:
    return (F.col("_id") == F.col("_first._id")) & (F.col("_key") == F.col("_first._key"))


def _marked(around: DataFrame) -> DataFrame:
    """``_whole``, the stretch to delete, for places whose context stands in an earlier document; without
    one, the places at which single runs are to be compared: repeats within a document, and the
    first place of a context where its document repeats it or its gram has other contexts too.

    The first place of any run is the first of its context, so it is among them if it is needed.
    """
    in_first = F.struct("_id", "_key", (-F.col("at")).alias("back"))
    classes = staged(
        around.groupBy("gram", "context").agg(F.min(_place()).alias("_first"), F.min(in_first).alias("_back")), "classes"
    )
    many = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("gram", F.lit(True).alias("_many"))
    repeats = F.col("_many").isNotNull() | (-F.col("_back.back") != F.col("_first.at"))
    known = staged(
        classes.join(staged(many, "many"), "gram", "left").select("gram", "context", "_first", repeats.alias("_open")), "classes"
    )
    met = around.join(known, ["gram", "context"])
    # A context that stands once and whose gram has no other is met by its own repeated row only.
    is_first = _place() == F.col("_first")
    whole = F.when(~_own(), _range(_start(F.col("at")), F.col("b")))
    return met.filter(~is_first | F.col("_open")).select("_id", "_key", "at", whole.alias("_whole"))


def _left(text: Column, tokens: Column) -> Column:
    """The text without the words of ``_ranges`` and the blanks after them."""

    def of_places(places: Column) -> Column:
        def gone(r: Column, k: Column) -> Column:
            before = F.get("_ranges", k - 1)
            start = F.when(before["a"] <= r["a"], F.greatest(r["a"], before["b"])).otherwise(r["a"])
            first, end = F.get(places, start), F.coalesce(F.get(places, r["b"]), F.size(tokens))
            return F.when(start < r["b"], F.sequence(first, end - 1)).otherwise(F.array().cast("array<int>"))

        kept = F.array_except(every, F.flatten(F.transform("_ranges", gone)))
        return F.array_join(F.transform(kept, lambda k: F.get(tokens, k)), "")

    every = F.sequence(F.lit(0), F.size(tokens) - 1)
    filled = F.filter(F.transform(tokens, lambda t, k: F.when(_bare(t) != "", k).otherwise(-1)), lambda k: k >= 0)
    # Without two blanks in a row every token is a word.
    spaced = text
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(BLANKS[0]))
    doubled = F.startswith(spaced, F.lit(BLANKS[0])) | F.contains(spaced, F.lit(BLANKS[0] * 2))
    return _let(F.when(doubled, filled).otherwise(every), of_places)


def drop_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the later copies of repeated runs of ``RUN`` words or more; ``_n_lines`` (the
    lines of a text) and ``_n_removed`` (by how many they became fewer) are added.

    Rows with a null id or text stay as they are, and so does what is left of a text. Of copies
    in one document the first stays; rows with the same id and the same text share one
    decision, so neither deletes the other. An empty table gives no rows. All columns stay,
    whatever their names; ones named as the two that are added are replaced.
    """
    docs = docs.drop("_n_lines", "_n_removed")
    inner, _ = apart(docs, doc=id_col, text=text_col)
    ranges = repeated_runs(inner, "doc", "text").select(F.col("_id").alias("_run_id"), F.col("_key").alias("_run_key"), "_ranges")
    same = (F.col("doc").cast("bigint") == F.col("_run_id")) & (F.xxhash64("text") == F.col("_run_key"))
    repeats = F.col("_ranges").isNotNull()
    text = F.col("text")
    left = F.when(repeats, _let(_tokens(text), lambda t: _left(text, t)))
    done = inner.join(ranges, same, "left").withColumns({"_left": left, "_n_lines": _n_lines(text)})
    return done.select(
        *(F.when(repeats, F.col("_left")).otherwise(text).alias(c) if c == "text" else F.col(c) for c in inner.columns),
        "_n_lines",
        F.when(repeats, F.col("_n_lines") - _n_lines(F.col("_left"))).otherwise(0).alias("_n_removed"),
    ).toDF(*docs.columns, "_n_lines", "_n_removed")
