"""Benchmark decontamination: template windows with typed placeholders, hash-joined, with a check of their slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import checkpoint

WINDOW = 5
SIMILARITY = 0.8
#: A window of a template must have so many words that aren't placeholders.
LITERALS = 2
#: Words of an item, placeholders aside, that outweigh one name exchanged for another.
LITERALS_A_NAME = 6
#: Up to so many different windows of the benchmark are compared with inside the scan; more are joined by a shuffle.
IN_SCAN = 50_000
NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
#: Stands before capitalised words that begin a text, line or sentence.
BEGINS = "\u0004"
#: Longs of the table of bits that the scan looks windows up in.
BITS = 1 << 14
#: Characters of scripts that put no spaces between words (Chinese, Japanese, Thai, Lao, Burmese, Khmer); each is a word of its own.
UNSPACED = r"\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\x{20000}-\x{3ffff}\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
UNITS = "km|kg|cm|mm|mg|ml|kwh|mph|kph|hz|khz|mhz|ghz|kb|mb|gb|tb|usd|eur|gbp|m|g|l|s|h|percent|dollars?|euros?|pounds?|cents?|meters?|metres?|miles?|feet|inches|grams?|liters?|litres?|seconds?|minutes?|hours?|days?|weeks?|months?|years?|degrees?"
#: Loops only over sets of characters: Java's loops over groups take stack for each turn, which long texts exhaust.
A_NUMBER = r"\p{Nd}(?:[\p{Nd}.,:/]*\p{Nd})?"
#: A word: a capitalised one within a sentence (with the space before it, by which it's told), letters with or without a number, a number.
TOKEN = rf" (?<=[\p{{L}}\p{{N}},;)] )\p{{Lu}}\p{{Ll}}+(?![\p{{L}}\p{{N}}])|\p{{L}}+(?:{A_NUMBER})?|{A_NUMBER}"
#: Numbers and signs between letters.
FORMULA = r"\p{Nd}[^\p{L}]*"


def tokens(text: Column) -> Column:
    """A text's words as they are written, names within sentences with the space before them."""
    apart = F.when(F.octet_length(text) == F.length(text), text).otherwise(F.regexp_replace(text, f"[{UNSPACED}]", " $0 "))
    return F.regexp_extract_all(apart, F.lit(TOKEN), F.lit(0))


def template(words: Column) -> Column:
    """Lower-case words with placeholders for numbers, for units after numbers and for names.

    Capitalised words at a beginning may be names or not; they are marked by BEGINS.
    """

    def numbered(x: Column) -> Column:
        """Whether a word ends in a digit; other digits than ASCII's come after all of its characters."""
        last = F.substring(x, -1, 1)
        return (last < "A") | ((last >= "\u0660") & x.rlike(r"\p{Nd}$"))

    def placeholder(x: Column, i: Column) -> Column:
        low = F.lower(x)
        unit = (i > 0) & numbered(F.get(words, i - 1)) & low.rlike(f"^(?:{UNITS})$")
        begins = (low != x) & x.rlike(r"^\p{Lu}\p{Ll}+$")
        return F.when(x.startswith(" "), NAME).when(numbered(x), F.regexp_replace(low, A_NUMBER, NUMBER)).when(unit, UNIT).when(begins, F.concat(F.lit(BEGINS), low)).otherwise(low)

    return F.transform(words, placeholder)


def plain(words: Column) -> Column:
    """The same words in lower case without placeholders."""
    return F.transform(words, lambda x: F.lower(F.ltrim(x)))


def formulas(text: Column) -> Column:
    """Hashes of a text's runs of numbers and signs, white space beside signs aside; one of a single number counts only in a text without letters."""
    tidy = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"\s+", " "), r" ?([^\p{Nd} .,]) ?", "$1"), r"[\s.,;:!?'\")\]]+$", "")
    runs = F.transform(F.regexp_extract_all(text, F.lit(FORMULA), 0), tidy)
    lettered = text.rlike(r"\p{L}")
    return F.transform(F.filter(runs, lambda x: ~lettered | x.rlike(r"[^\p{Nd}.,][^\p{Nd}]*\p{Nd}")), lambda x: F.xxhash64(F.lit(0), x))


def hashed(words: Column) -> Column:
    """Hash of each word, taken once; windows hash these."""
    return F.transform(words, lambda w: F.xxhash64(w))


def hash_at(h: Column, i: Column, first: Column | None = None) -> Column:
    return F.xxhash64(first if first is not None else F.get(h, i), *[F.get(h, i + k) for k in range(1, WINDOW)])


def starts(h: Column, wide: int = WINDOW) -> Column:
    """Places of all windows; none if there are fewer words."""
    return F.when(F.size(h) >= wide, F.sequence(F.lit(0), F.greatest(F.size(h) - wide, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def short_hash(h: Column, i: Column, wide: int) -> Column:
    """Hash of a sequence of fewer words than a window has; a negative width tells that it has to be the whole text."""
    return F.xxhash64(F.lit(wide), *[F.get(h, i + k) for k in range(abs(wide))])


def hash_begun(h: Column, i: Column) -> Column:
    """Hash of a window of which capitalised words at a beginning are taken for names."""
    return F.xxhash64(F.lit(BEGINS), *[F.get(h, i + k) for k in range(WINDOW)])


def bits_of(hashes: list[int]) -> Column:
    """A table of bits of these hashes, as a folded array of longs: a superset of them passes, the join decides."""
    bits = [0] * BITS
    for h in hashes:
        bits[(h >> 6) & (BITS - 1)] |= 1 << (h & 63)
    return F.split(F.lit(",".join(str(b - (1 << 64) if b >> 63 else b) for b in bits)), ",").cast("array<bigint>")


def mark_slots(words: Column, raw: Column, i: Column) -> Column:
    """(place, word, whether it's a name) of a window's placeholders."""
    at = F.filter(F.sequence(F.lit(0), F.lit(WINDOW - 1)), lambda k: F.get(words, i + k).rlike(f"[{NUMBER}{NAME}{UNIT}]"))
    return F.transform(at, lambda k: F.struct(k.alias("k"), F.coalesce(F.get(raw, i + k), F.lit("")).alias("v"), (F.get(words, i + k) == NAME).alias("name")))


PLACED = "array<struct<i:int,h:bigint>>"


def placed(at: Column, h) -> Column:
    """(i, h) of places; h gives the hash at one."""
    return F.transform(at, lambda i: F.struct(i.alias("i"), h(i).alias("h")))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(h, item, j, lit, n, need, n_all, need_all, words, slots): windows of each different template; item is its least id.

    Windows of the template with enough literals (lit), of which need of n must be found, and beside them windows of plain
    words at the same places, whatever their case, of which need_all of n_all must be. An item of fewer words is one
    window, one without letters is its numbers and signs. words is the number of the item's words that aren't
    placeholders. A word that stands at a beginning is a name if it stands as one elsewhere in the item.
    """
    items = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    rows = items.select("item", tokens(F.col("text")).alias("x")).select("item", template(F.col("x")).alias("w"), plain(F.col("x")).alias("r"))
    rows = rows.withColumn("names", F.filter(F.transform("w", lambda x, i: F.when(x == NAME, F.get("r", i))), lambda x: x.isNotNull()))
    rows = rows.withColumn("w", F.transform("w", lambda x, i: F.when(x.startswith(BEGINS) & F.array_contains("names", F.get("r", i)), BEGINS + NAME).otherwise(F.translate(x, BEGINS, ""))))
    # A name at a beginning is one like any other; only begun tells that it stands there.
    rows = rows.select("item", F.array_join("r", " ").alias("p"), F.transform("w", lambda x: x == BEGINS + NAME).alias("begun"), F.translate(F.array_join("w", " "), BEGINS, "").alias("t")).where("t != ''")
    one = rows.groupBy("t").agg(F.min(F.struct("item", "p", "begun")).alias("x")).select("t", "x.begun", F.col("x.item").alias("item"), F.split("t", " ").alias("w"), F.split("x.p", " ").alias("r"))
    one = checkpoint(one.withColumns({"hw": hashed(F.col("w")), "hr": hashed(F.col("r"))}))
    literal = lambda w: F.size(F.filter(w, lambda x: ~x.rlike(f"[{NUMBER}{NAME}{UNIT}]")))
    lettered = lambda x: x.rlike(r"\p{L}")
    # A window of plain words must hold a letter.
    cut = placed(F.filter(starts(F.col("hw")), lambda i: literal(F.slice("w", i + 1, WINDOW)) >= LITERALS), lambda i: hash_at(F.col("hw"), i))
    words = placed(F.filter(starts(F.col("hr")), lambda i: F.exists(F.slice("r", i + 1, WINDOW), lettered)), lambda i: hash_at(F.col("hr"), i))
    # Single words, and a few characters of unspaced scripts, are found as whole texts only.
    wide = lambda k: F.when((F.size("r") == 1) | F.exists("r", lambda x: x.rlike(f"[{UNSPACED}]")), short_hash(F.col("hr"), F.lit(0), -k)).otherwise(short_hash(F.col("hr"), F.lit(0), k))
    few = [F.when((F.size("r") == k) & F.exists("r", lettered), F.array(F.struct(F.lit(0).alias("i"), wide(k).alias("h")))).otherwise(F.array().cast(PLACED)) for k in range(1, WINDOW)]
    own = F.concat(words, *few)
    kept = checkpoint(one.select("t", "item", "w", "r", "hw", "begun", cut.alias("x"), own.alias("y"), literal(F.col("w")).alias("words")))
    places = F.transform("x", lambda x: x["i"])
    n_all = F.size(F.array_union(places, F.transform("y", lambda x: x["i"])))
    need = lambda n: F.ceil(n * F.lit(SIMILARITY) - 1e-9)
    kept = kept.select("t", "w", "r", "hw", "begun", "item", "x", places.alias("places"), F.size("x").alias("n"), need(F.size("x")).alias("need"), n_all.alias("n_all"), need(n_all).alias("need_all"), "words")
    told = ("item", "n", "need", "n_all", "need_all", "words")
    each = kept.select("w", "r", "hw", "begun", *told, F.explode("x").alias("x"))
    first = each.select(*told, F.lit(True).alias("lit"), F.col("x.i").alias("j"), F.col("x.h").alias("h"), mark_slots(F.col("w"), F.col("r"), F.col("x.i")).alias("b"))
    # In a text the first word may follow a word without a stop, and then looks like a name.
    named = each.where("x.i = 0").select(*told, F.lit(True).alias("lit"), F.lit(0).alias("j"), hash_at(F.col("hw"), F.lit(0), F.xxhash64(F.lit(NAME))).alias("h"), F.filter(mark_slots(F.col("w"), F.col("r"), F.lit(0)), lambda s: s["k"] > 0).alias("b"))
    begun = each.where(F.exists(F.slice("begun", F.col("x.i") + 1, WINDOW), lambda x: x))
    begun = begun.select(*told, F.lit(True).alias("lit"), F.col("x.i").alias("j"), hash_begun(F.col("hw"), F.col("x.i")).alias("h"), mark_slots(F.col("w"), F.col("r"), F.col("x.i")).alias("b"))
    # Items that share a template have plain words of their own.
    variants = rows.select("t", F.split("p", " ").alias("r")).distinct().withColumn("hr", hashed(F.col("r"))).join(kept.select("t", "places", *told), "t")
    same = variants.select(*told, "places", own.alias("y")).select(*told, "places", F.explode("y").alias("y"))
    same = same.select(*told, F.array_contains("places", F.col("y.i")).alias("lit"), F.col("y.i").alias("j"), F.col("y.h").alias("h"), F.array().cast("array<struct<k:int,v:string,name:boolean>>").alias("b"))
    # Items without letters; each has its own, as numbers and signs are all they have.
    signs = items.where(~F.col("text").rlike(r"\p{L}")).select("item", F.explode(formulas(F.col("text"))).alias("h")).groupBy("h").agg(F.min("item").alias("item"))
    signs = signs.select("item", F.lit(0), F.lit(0).cast("long"), F.lit(1), F.lit(1).cast("long"), F.lit(0), F.lit(False), F.lit(0), "h", F.array().cast("array<struct<k:int,v:string,name:boolean>>"))
    return checkpoint(first.union(named).union(begun).union(same).union(signs).dropDuplicates(["h", "item", "j"]))


def matches(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", in_scan: int = IN_SCAN) -> DataFrame:
    """(doc_id, mark, item, n, found, changed): documents that hold a benchmark item, also with other numbers, names or units.

    An item is found if at least SIMILARITY of its windows of five words are, as the same words whatever their case and
    white space, or in windows whose slots are consistent: along
    one alignment, each word that stands in slots of the item has always the same counterpart. Each name with another
    counterpart must be outweighed by LITERALS_A_NAME words of the item that aren't placeholders: capitals don't make a
    name, least of all in German, and a sentence with most nouns exchanged is another sentence. changed says whether some
    counterpart differs: a re-parameterised question. mark is a hash of the text; with doc_id it names the row.
    """
    known = benchmark_windows(benchmark, item_col, item_text_col)
    hashes = [x[0] for x in known.select("h").distinct().limit(in_scan + 1).collect()]  # bounded
    # A window may be of many items, so the rows that would be sent to all executors are counted as well.
    few = len(hashes) <= in_scan and known.limit(2 * in_scan + 1).count() <= 2 * in_scan
    item = F.col(item_text_col).cast("string")
    sizes = sorted(x[0] for x in benchmark.select(F.size(tokens(item)).alias("n")).where(F.col("n").between(1, WINDOW - 1)).distinct().collect())
    signs = not benchmark.where(~item.rlike(r"\p{L}") & item.rlike(r"\p{Nd}")).isEmpty()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), tokens(text).alias("x"), (formulas(text) if signs else F.array().cast("array<bigint>")).alias("signs"))
    rows = rows.select("doc_id", "mark", "signs", template(F.col("x")).alias("w"), plain(F.col("x")).alias("r"))
    mark = lambda w: F.when(w.startswith(BEGINS), F.lit(None).cast("bigint")).otherwise(F.xxhash64(w))
    rows = rows.select("doc_id", "mark", "signs", "r", F.transform("w", mark).alias("hm"), hashed(F.col("r")).alias("hr"))
    hm, hr, hw, hb = F.col("hm"), F.col("hr"), F.col("hw"), F.col("hb")
    # Words at a beginning (null in hm) are plain words in hw and names in hb.
    rows = rows.select("*", F.transform("hm", lambda x, i: F.coalesce(x, F.get("hr", i))).alias("hw"), F.transform("hm", lambda x: F.coalesce(x, F.xxhash64(F.lit(NAME)))).alias("hb"))
    # The windows' table of bits is bounded, so it goes to the scan; only windows that may be in it become rows.
    bits = bits_of(hashes) if few else None
    in_bits = lambda h: F.bit_get(F.get(bits, F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(BITS - 1)).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1
    # exists() names the hash, so that it is taken once.
    wanted = (lambda h: F.exists(F.array(h), in_bits)) if few else (lambda h: F.lit(True))
    by_words = F.filter(starts(hr), lambda i: wanted(hash_at(hr, i)))
    around = lambda at: F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(F.greatest(i - (WINDOW - 1), F.lit(0)), i))))
    every = F.sequence(F.lit(0), F.greatest(F.size(hw) - 1, F.lit(0)))
    # Windows without a placeholder are those of plain words; only the others are hashed by the template.
    near = around(F.filter(every, lambda i: ~F.get(hw, i).eqNullSafe(F.get(hr, i))))
    by_template = F.filter(near, lambda i: (i <= F.size(hw) - WINDOW) & wanted(hash_at(hw, i)))
    by_begun = F.filter(around(F.filter(every, lambda i: F.get(hm, i).isNull())), lambda i: (i <= F.size(hw) - WINDOW) & wanted(hash_begun(hb, i)))
    none = F.array().cast("array<int>")
    few_words = lambda k: lambda i: short_hash(hr, i, k)
    wides = [-k for k in sizes] + [k for k in sizes if k > 1]
    within = lambda k: starts(hr, k) if k > 0 else F.when(F.size(hr) == -k, F.array(F.lit(0))).otherwise(none)
    short = [F.filter(within(k), (lambda at: lambda i: wanted(at(i)))(few_words(k))) for k in wides]
    alike = F.transform(F.filter("signs", wanted), lambda h: F.struct(F.lit(0).alias("i"), h.alias("h")))
    hit = rows.select("doc_id", "mark", "r", "hw", "hr", "hb", by_template.alias("at"), by_begun.alias("begun"), by_words.alias("own"), F.array(*short).cast("array<array<int>>").alias("short"), alike.cast(PLACED).alias("signs"))
    # Rows without windows go at the explode; a filter would be pushed below and repeat these expressions.
    hits = F.concat(placed(F.col("at"), lambda i: hash_at(hw, i)), placed(F.col("begun"), lambda i: hash_begun(hb, i)), placed(F.col("own"), lambda i: hash_at(hr, i)), *[placed(F.get("short", F.lit(n)), few_words(k)) for n, k in enumerate(wides)], F.col("signs"))
    slots = lambda i: F.transform(F.sequence(F.lit(0), F.lit(WINDOW - 1)), lambda k: F.coalesce(F.get("r", i + k), F.lit("")))
    found = hit.select("doc_id", "mark", F.explode(F.transform(hits, lambda x: F.struct(x["i"].alias("i"), x["h"].alias("h"), slots(x["i"]).alias("d")))).alias("x"))
    met = found.select("doc_id", "mark", "x.i", "x.h", "x.d").join(F.broadcast(known) if few else known, "h")
    pair = F.transform("b", lambda s: F.struct(s["v"].alias("b"), F.get("d", s["k"]).alias("d"), s["name"].alias("name")))
    told = ("doc_id", "mark", "item", "n", "need", "n_all", "need_all", "words")
    met = met.select(*told, (F.col("i") - F.col("j")).alias("shift"), "j", "lit", pair.alias("pairs"))
    # Along one alignment an item's window is met at most twice, so what is gathered is bounded by the item's length.
    lines = met.groupBy(*told, "shift").agg(F.collect_list(F.struct("j", "lit", "pairs")).alias("x"))
    seen = F.array_distinct(F.flatten(F.transform("x", lambda x: x["pairs"])))
    lines = lines.withColumn("seen", seen).withColumn("bad", F.filter(F.transform("seen", lambda p: p["b"]), lambda b: F.size(F.filter("seen", lambda q: q["b"] == b)) > 1))
    names = F.size(F.array_distinct(F.transform(F.filter("seen", lambda p: p["name"] & (p["b"] != p["d"])), lambda p: p["b"])))
    lines = lines.withColumn("heavy", names * LITERALS_A_NAME > F.col("words"))
    good = F.filter("x", lambda x: ~F.exists(x["pairs"], lambda p: F.array_contains("bad", p["b"]) | (F.col("heavy") & p["name"] & (p["b"] != p["d"]))))
    good = F.transform(good, lambda x: F.struct(x["j"].alias("j"), x["lit"].alias("lit"), F.exists(x["pairs"], lambda p: p["b"] != p["d"]).alias("other")))
    each = lines.select(*told, F.explode(good).alias("g")).groupBy(*told, F.col("g.j").alias("j")).agg(F.max("g.lit").alias("lit"), F.min("g.other").alias("other"))
    sums = each.groupBy(*told).agg(F.count_if("lit").alias("found_lit"), F.count("*").alias("found"), F.max(F.when(F.col("lit"), F.col("other"))).alias("changed_lit"), F.max("other").alias("changed"))
    by_template, by_all = (F.col("n") > 0) & (F.col("found_lit") >= F.col("need")), (F.col("n_all") > 0) & (F.col("found") >= F.col("need_all"))
    of = lambda a, b: F.when(by_template, F.col(a)).otherwise(F.col(b))
    return sums.where(by_template | by_all).select("doc_id", "mark", "item", of("n", "n_all").alias("n"), of("found_lit", "found").alias("found"), of("changed_lit", "changed").alias("changed"))


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Contaminated documents with the items they hold: doc_id, item_id, n_windows, n_found, share, reparameterised.

    item_id is the least id of the items with the same template. Null and empty texts hold nothing; an item of two to four
    words is found by its whole sequence, one of a single word only as a whole text. Characters of scripts without spaces
    are words each; fewer than five of them are found only as a whole text. An item without letters is found where its
    numbers and signs stand whole between letters, one of a single number only as a whole text; an item without letters
    and digits has nothing to find. A null key stays null; repeated rows count once; an empty table on either side gives no rows; other columns are left out.
    """
    found = matches(df, benchmark, id_col, text_col, item_col, item_text_col)
    return found.select("doc_id", F.col("item").alias("item_id"), F.col("n").cast("long").alias("n_windows"), F.col("found").alias("n_found"), (F.col("found") / F.col("n")).alias("share"), F.col("changed").alias("reparameterised"))


def keep_clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that hold no item, with all their columns. Rows are told by key and text, also those with a null key."""
    found = matches(df, benchmark, id_col, text_col).select(F.col("doc_id").alias("id"), "mark").distinct()
    # The row's own columns stand in one, so that no name of theirs meets one of ours.
    rows = df.select(F.col(id_col).cast("long").alias("key"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("hash"), F.struct("*").alias("row"))
    return rows.join(found, F.col("key").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("mark")), "left_anti").select("row.*")
