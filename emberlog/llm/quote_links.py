"""Quotation linking: quoted passages are hashed, joined to the messages they come from, and conversations ordered by reply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.llm.common import checkpoint

SALTS = 16
#: Parts of messages are looked up by their first words, so many at most.
ANCHOR = 16
#: A part of a message of another conversation counts only with so many words; fewer are said by chance.
FEW = 5
#: A line that tells whose words the quote below it gives, up to its colon; English, German, French, Spanish and Italian.
ATTRIBUTION = r"(?:on [^\n]*\bwrote|am [^\n]*\bschrieb[^\n:]*|le [^\n]*\ba écrit|el [^\n]*\bescribió|il [^\n]*\bha scritto)"
#: What stands for words that a quote leaves out.
ELISION = r"\[[ \t]*(?:\.{3}|…)[ \t]*\]"
#: Numbers of first words that anchors may have: the greatest that a unit reaches is taken.
ANCHORS = (1, 2, 4, 8, ANCHOR)


def levelled(text: Column) -> Column:
    """The text with each quoted line's marks as >>> and nothing between; a line that only says who wrote the quote right below it is left out."""
    lines = F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)
    bare = F.regexp_replace(lines, r"(?md)^[ \t]+(?=>)", "")
    # A blank between two marks belongs to them; marks are followed from the line's start, one by one, however many there are.
    marked = F.regexp_replace(bare, r"(?md)(?:^|\G(?!^))>[ \t]?(?=>)", ">")
    return F.when(F.contains(text, F.lit(">")), F.regexp_replace(marked, rf"(?mdiu)^(>*)[ \t]*{ATTRIBUTION}[ \t]*:[ \t]*\n(?:\1[ \t]*\n)?(?=\1>)", "")).otherwise(lines)


def normal(passage: Column) -> Column:
    """Lower-case words of a passage without quote marks."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(passage, r"(?md)^>+", " ")), r"[\s>]+", " "))


def word_hashes(p: Column) -> Column:
    return F.transform(F.split(p, " "), lambda w: F.xxhash64(w))


def own_text(text: Column) -> Column:
    """The text without quoted lines and the empty lines they leave around."""
    bare = F.when(F.contains(text, F.lit(">")), F.regexp_replace(text, r"(?md)^>.*(?:\n|\z)", "")).otherwise(text)
    return F.regexp_replace(F.regexp_replace(bare, r"\n{3,}", "\n\n"), r"^\s+|\s+\z", "")


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages without their quotes, tied to what they quote, a row per input row.

    conv_id, turn, role, text (own text); n_quotes (quoted passages), max_level, n_linked (passages whose message is
    found); parent_conv, parent_turn (the message that the first-level quotes come from: the latest of those found; null
    without); root_conv, root_turn and depth (of the thread of replies). A conversation in reply order is its rows
    sorted by (root_turn, depth, turn).

    A passage is a run of lines of one level; it comes from the message whose own text, paragraph or line is the same in
    lower case and with white space as one space: the earliest one in the same conversation before the quoting message,
    else the earliest one of all conversations with lesser ids; fewer than FEW words only if a single other conversation
    has them. Else it comes from the message that all its paragraphs,
    or all its lines, or the pieces between its elisions, such as [...], come from in this way. Else the same holds with any run of whole words of a message's own text, of
    another conversation only if it has at least FEW words. Null texts are empty; rows with
    a null conversation or turn are kept but neither quote nor are quoted; rows with equal conversation and turn are one
    message for linking; an empty table gives none; other columns are left out. Candidates are minima by hash, so no
    group is gathered; a passage that very many messages quote is dealt out by salts.
    """
    text = levelled(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), text.alias("full"))
    named = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    quoted = checkpoint(_passages(named.where(F.col("full").rlike("(?md)^>")).select("conv_id", "turn", "full").distinct()))

    own = own_text(F.col("full"))
    parts = F.array_distinct(F.concat(F.array(own), F.split(own, r"\n[ \t]*\n"), F.split(own, "\n")))
    passages = named.select("conv_id", "turn", F.explode(parts).alias("p")).select("conv_id", "turn", normal(F.col("p")).alias("p")).where("p != ''").select("conv_id", "turn", F.xxhash64("p").alias("h"))
    wanted = quoted.select("h").distinct()
    first = checkpoint(passages.join(wanted, "h", "left_semi").groupBy("h", "conv_id").agg(F.min("turn").alias("turn")))
    exact = checkpoint(_sources(quoted, first, "h"))
    met = checkpoint(_agreed(exact))
    open_ = checkpoint(exact.join(met.where("source IS NULL").select("conv_id", "turn", "level", "q"), ["conv_id", "turn", "level", "q"], "left_semi"))
    parts_found = _parts(named, open_)
    if parts_found is not None:
        partly = _sources(open_.withColumnRenamed("source", "whole"), parts_found, "g")
        partly = _agreed(partly.withColumn("source", F.coalesce("whole", F.when((F.col("source.conv_id") == F.col("conv_id")) | (F.col("n") >= FEW), F.col("source")))))
        met = checkpoint(met.where("source IS NOT NULL").unionByName(partly))
    near = F.max(F.when((F.col("level") == 1) & (F.col("source.conv_id") == F.col("conv_id")), F.col("source")))
    far = F.max(F.when(F.col("level") == 1, F.col("source")))
    linked = checkpoint(met.groupBy("conv_id", "turn").agg(F.count("*").alias("n_quotes"), F.max("level").alias("max_level"), F.count("source").alias("n_linked"), F.coalesce(near, far).alias("parent")))

    tree = _roots(linked.where("parent IS NOT NULL").select("conv_id", "turn", "parent"))
    found = linked.join(tree, ["conv_id", "turn"], "left")
    out = rows.join(found, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", own_text(F.col("full")).alias("text"), F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.coalesce("max_level", F.lit(0)).cast("long").alias("max_level"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("parent.conv_id").alias("parent_conv"), F.col("parent.turn").alias("parent_turn"),
        F.coalesce("root.conv_id", "conv_id").alias("root_conv"), F.coalesce("root.turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def _passages(rows: DataFrame) -> DataFrame:
    """Units of the quoted passages of messages, which are runs of lines of one level: the run, its paragraphs, its lines.

    (conv_id, turn, level, q, kind, h, g, n, k, a): q tells passages apart; h and g are hashes of a unit's text and words,
    n is their number, a the hash of the first k. A window holds the lines of one message.
    """
    lines = rows.select("conv_id", "turn", F.xxhash64("full").alias("m"), F.posexplode(F.split("full", "\n")).alias("n", "line"))
    lines = lines.withColumn("level", F.length(F.regexp_extract("line", "^(>*)", 1)))
    order = W.partitionBy("conv_id", "turn", "m").orderBy("n")
    starts = (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int")
    runs = lines.withColumn("s", starts).withColumn("run", F.sum("s").over(order.rowsBetween(W.unboundedPreceding, 0))).where("level > 0")
    texts = runs.groupBy("conv_id", "turn", "m", "run", "level").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("text"))
    texts = texts.select("conv_id", "turn", "level", "text", normal(F.col("text")).alias("p")).where("p != ''")
    texts = texts.groupBy("conv_id", "turn", "level", F.xxhash64("p").alias("q")).agg(F.min("text").alias("text"))
    units = lambda pattern: F.array_distinct(F.filter(F.transform(F.split("text", pattern), normal), lambda p: p != ""))
    elided = F.when(F.col("text").rlike(ELISION), units(ELISION)).otherwise(F.array().cast("array<string>"))
    kinds = F.array(F.array(normal(F.col("text"))), units(r"(?md)^>+[ \t]*$"), units("\n"), elided)
    each = texts.select("conv_id", "turn", "level", "q", F.posexplode(kinds).alias("kind", "ps")).where("kind = 0 OR size(ps) > 1").select("conv_id", "turn", "level", "q", "kind", F.explode("ps").alias("p"))
    w = word_hashes(F.col("p"))
    each = each.select("conv_id", "turn", "level", "q", "kind", F.xxhash64("p").alias("h"), w.alias("w")).withColumn("n", F.size("w"))
    k = F.coalesce(*[F.when(F.col("n") >= k, k) for k in sorted(ANCHORS, reverse=True)])
    return each.withColumn("k", k).select("conv_id", "turn", "level", "q", "kind", "h", F.xxhash64("w").alias("g"), "n", "k", F.xxhash64(F.slice("w", F.lit(1), F.col("k"))).alias("a"))


def _sources(quoted: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """quoted with source, the message that a unit comes from: the earliest in the conversation, else of those with lesser ids; of few words only if one other conversation alone has them. first has a row per hash and conversation."""
    first = first.withColumnRenamed("h", key)
    inside = first.select(key, "conv_id", F.col("turn").alias("own_turn"))
    outside = first.groupBy(key).agg(F.min(F.struct("conv_id", "turn")).alias("o"), F.count("*").alias("convs")).select(key, "o", "convs", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = quoted.withColumn("salt", F.pmod(F.xxhash64("conv_id", "turn"), F.lit(SALTS)).cast("int"))
    met = salted.join(inside, [key, "conv_id"], "left").join(outside, [key, "salt"], "left")
    local = F.when(F.col("own_turn") < F.col("turn"), F.struct(F.col("conv_id").alias("conv_id"), F.col("own_turn").alias("turn")))
    told = (F.col("n") >= FEW) | (F.col("convs") - F.col("own_turn").isNotNull().cast("int") == 1)
    source = F.coalesce(local, F.when((F.col("o.conv_id") < F.col("conv_id")) & told, F.col("o")))
    return met.withColumn("source", source).drop("own_turn", "o", "convs", "salt")


def _agreed(units: DataFrame) -> DataFrame:
    """(conv_id, turn, level, q, source): of each passage, by the first kind of units that all come from one message."""
    one = (F.count("source") == F.count("*")) & (F.min("source") == F.max("source"))
    kinds = units.groupBy("conv_id", "turn", "level", "q", "kind").agg(F.when(one, F.min("source")).alias("source"))
    return kinds.groupBy("conv_id", "turn", "level", "q").agg(F.min_by("source", F.when(F.col("source").isNotNull(), F.col("kind"))).alias("source"))


def _parts(named: DataFrame, wanted: DataFrame) -> DataFrame | None:
    """(h, conv_id, turn): the earliest message of each conversation whose own text holds the words of a wanted unit; None if nothing is wanted.

    Places where a unit's first words stand are found by a join; only there whole units are hashed, once for each length.
    """
    sizes = sorted(r[0] for r in wanted.select("k").distinct().collect())  # of ANCHORS
    if not sizes:
        return None
    texts = named.select("conv_id", "turn", normal(own_text(F.col("full"))).alias("p")).where("p != ''").distinct()
    texts = checkpoint(texts.select("conv_id", "turn", F.xxhash64("p").alias("m"), word_hashes(F.col("p")).alias("w")))
    none = F.array().cast("array<struct<i:int,a:bigint>>")
    at = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - k + 1, F.lit(1))), lambda i: F.struct(i.alias("i"), F.xxhash64(F.slice("w", i, F.lit(k))).alias("a")))
    places = texts.select("conv_id", "turn", "m", F.explode(F.concat(none, *[F.when(F.size("w") >= k, at(k)).otherwise(none) for k in sizes])).alias("x"))
    anchors = wanted.groupBy("a").agg(F.collect_set("n").alias("ns"))
    hits = places.select("conv_id", "turn", "m", "x.i", "x.a").join(anchors, "a").groupBy("conv_id", "turn", "m").agg(F.collect_list(F.struct("i", "ns")).alias("xs"))
    found = hits.join(texts, ["conv_id", "turn", "m"])
    hashes = F.array_distinct(F.flatten(F.transform("xs", lambda x: F.transform(x["ns"], lambda n: F.xxhash64(F.slice("w", x["i"], n))))))
    found = found.select("conv_id", "turn", F.explode(hashes).alias("g")).join(wanted.select("g").distinct(), "g", "left_semi")
    return checkpoint(found.groupBy(F.col("g").alias("h"), "conv_id").agg(F.min("turn").alias("turn")))


def _roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) of replies, by pointers that double their reach each round. Parents come before replies, so there are no rings."""
    now = checkpoint(replies.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")))
    while True:
        ahead = now.select(F.struct("conv_id", "turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        met = now.join(ahead, "root", "left")
        if met.where("next IS NOT NULL").limit(1).count() == 0:
            break
        now = checkpoint(met.select("conv_id", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
    return now
