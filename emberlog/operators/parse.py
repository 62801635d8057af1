"""Log lines to records: noise, formats, continuation lines, times, runnables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emberlog.functions.text import after_first, before_first, message_hash, nonempty, strip
from emberlog.functions.times import epoch, local_to_utc

#: What the formats look like. Groups are the fields.
TS_T, TS_S = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2},\d{3}", r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2},\d{3}"
TS_D = r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}\.\d{3}"
WRAPPER = r"(?:INFO|ERROR|WARN|STATUS|DEBUG)\s+\|\s*jvm\s+\d+\s+\|\s*\d{4}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2}\s+\|\s*"
FORMATS = {
    "PIPE_8FIELD": rf"(?sU)^({TS_T})\|(\w+)\s*\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|(.*)",
    "SPRING": rf"(?sU)^({TS_T})\s+-\s+(INFO|WARN|ERROR|FATAL|DEBUG|TRACE)\s+\[([^\]]+)\]\s+-\s+(.*)",
    "RUNNABLE_HIST": rf"(?sU)^({TS_S})\|(\w+)\s+-\s+(.*)",
    "AGENT": rf"(?sU)^({TS_S})\|(\w+)\s*\|([^|]*)\|\s*(.*)",
    "REST_OPS": rf"(?sU)^({TS_D})\s+--\s+({TS_D})\s+\((\d+)ms\)\s+-\s+([^\s]+)\s+-\s+([^\s]+)\s+-\s+(\w+)\s+-\s+(.*)",
    "PLAIN_Z": r"(?sU)^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{2,3}Z)\s+(.*)",
    "PLAIN": rf"(?sU)^({TS_T})\s+(.*)",
}
FIELDS = {"PIPE_8FIELD": 8, "SPRING": 4, "RUNNABLE_HIST": 3, "AGENT": 4, "REST_OPS": 7, "PLAIN_Z": 2, "PLAIN": 2}
LEVELS = ("DEBUG", "INFO", "WARN", "ERROR", "FATAL")
NOISE = r"Reusing existing ZKC instance|Accepted login for user Clous"
CONTINUATION = r"(?U)^\s*$|^\s+(?:at\s|\.\.\.)|^\s*Caused by:\s|^[A-Za-z][\w.]*(?:Exception|Error|Throwable)[\s:]"
SMTP = ("DEBUG", "EHLO", "250", "220", "STARTTLS", "RCPT", "AUTH", "MAIL FROM", "354", "DATA")
EMAIL = ("Date:", "From:", "Reply-To:", "To:", "Message-ID:", "Subject:", "MIME-", "Content-", "---")
BANNER = r"(?U)^[\s_/\\|()U\"'>*=]+$|^Spring boot"
#: Stands for the name of a product where none is given: a word of four capitals before its version.
ANY_PRODUCT = r"[A-Z]{4}"
STATE_CHANGE = r"(?U)State change:\s*\w+\s*->\s*(\w+)"
#: Runnables whose instances carry their name without the suffix as prefix.
INSTANCES = ("arcm", "abs", "copernicus", "umcadmin", "adsadmin", "ces", "ecp", "dashboarding", "octopus", "simulation", "cloudsearch", "elastic", "zoo", "cdf", "apg", "loadbalancer")
#: What stands between fields while they are taken apart, and what stands for it and for itself in a line that holds it.
MARK, ESCAPE, OWN_MARK, OWN_ESCAPE = "\u0001", "\u0002", "\u0003", "\u0004"
#: Lines of a file that are folded in one task.
PIECE = 1 << 16


def is_noise(line: Column) -> Column:
    return line.rlike(NOISE)


def is_continuation(line: Column) -> Column:
    return line.rlike(CONTINUATION)


def unstructured_kind(line: Column, product: str | None = None) -> Column:
    """BUS, SMTP, EMAIL, BANNER or OTHER of a line that is no record; the first that fits.

    product: the name of the logged product, whose banner is a line that begins with it and "version".
    """
    named = F.startswith(strip(line), F.lit(f"{product} version")) if product else strip(line).rlike(f"^{ANY_PRODUCT} version")
    s = strip(line)
    starts = lambda ps: F.reduce(F.array(*[F.startswith(s, F.lit(p)) for p in ps]), F.lit(False), lambda a, x: a | x)
    return F.when(F.startswith(s, F.lit("BUS-")), "BUS").when(starts(SMTP), "SMTP").when(starts(EMAIL), "EMAIL").when(s.rlike(BANNER) | named, "BANNER").otherwise("OTHER")


def log_family(name: Column, wrapper_file: str | None = None) -> Column:
    """Family of a log file by its name. wrapper_file: the exact name, in lower case, of the wrapper's own log; None takes any cloud agent's."""
    n = F.lower(name)
    return (
        F.when((n == wrapper_file if wrapper_file else F.endswith(n, F.lit("cloudagent.log"))) | F.contains(n, F.lit("wrapperlog")), "WRAPPER_LOG")
        .when(n == "runnable_history.log", "RUNNABLE_HISTORY")
        .when(n == "agent_rest_operations.log", "REST_OPS")
        .when(n == "agent_login.log", "AGENT_LOGIN")
        .when(n.isin("agent_error.log", "agent.error.log"), "AGENT_ERROR")
        .when(F.startswith(n, F.lit("agent")), "AGENT_LOG")
        .when(n == "zkc.log", "ARCM_ZKC")
        .when(n.isin("arcm.log", "arcm-error.log"), "ARCM_APP")
        .when(n.rlike("^copernicus[_.]publishing"), "COPERNICUS_PUB")
        .when((n == "system.out.log") | F.startswith(n, F.lit("system_out")), "SYSTEM_OUT")
        .otherwise("UNKNOWN")
    )


def runnable_of(path: Column, instance: Column, thread: Column) -> Column:
    """Runnable by path, else by instance's prefix, else by thread, else agent if the path says so."""
    some = lambda c, p: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), p, 1), F.lit(""))
    prefix = some(instance, "^([a-z]+)")
    return F.coalesce(some(path, r"(?U)(?:runnable_|work_)(\w+_s)"), F.when(prefix.isin(*INSTANCES), F.concat(prefix, F.lit("_s"))), some(thread, r"(?U)\b(\w+_s)\b"), F.when(F.contains(F.lower(path), F.lit("agent")), "agent"), F.lit("unknown"))


def new_state(message: Column, format_type: Column) -> Column:
    """State that a history record changes to; null for others."""
    return F.when((format_type == "RUNNABLE_HIST") & F.contains(message, F.lit("State change:")), F.nullif(F.regexp_extract(message, STATE_CHANGE, 1), F.lit("")))


def parse_lines(lines: DataFrame, line: str = "line", tz_mode: str = "approx") -> DataFrame:
    """Adds parsed columns to lines: format_type (null for no record), ts, level, instance_id, tenant, session_id, request_id, thread, logger, message, content_runnable, duration_ms, end_ts, bad_time.

    The format is one ladder of tests; its fields come out of one replacement, which puts a mark between them. A line whose
    time can't be read, a 13th month say, has bad_time and counts as no record.
    """
    raw = F.regexp_replace(F.coalesce(F.col(line), F.lit("")), r"[\r\n]+$", "")
    inner = F.regexp_replace(raw, rf"(?sU)^(?:{WRAPPER})+", "")
    base = lines.withColumns({"__raw": raw, "__in": inner}).withColumn("__wrapped", F.col("__raw") != F.col("__in"))
    ladder = F.lit(None).cast("string")
    for name in reversed(FORMATS):
        ladder = F.when(F.col("__in").rlike(FORMATS[name]), F.lit(name)).otherwise(ladder)
    base = base.withColumn("__f", ladder)
    # Marks that a line holds itself stand for themselves by two others, which no pattern treats in another way.
    holds = F.contains(F.col("__in"), F.lit(MARK)) | F.contains(F.col("__in"), F.lit(ESCAPE))
    base = base.withColumn("__safe", F.when(holds, F.replace(F.replace("__in", F.lit(ESCAPE), F.lit(ESCAPE + OWN_ESCAPE)), F.lit(MARK), F.lit(ESCAPE + OWN_MARK))).otherwise(F.col("__in")))
    fields = F.lit(None).cast("string")
    for name, pattern in FORMATS.items():
        fields = F.when(F.col("__f") == name, F.regexp_replace("__safe", pattern, MARK.join(f"${k}" for k in range(1, FIELDS[name] + 1)))).otherwise(fields)
    base = base.withColumn("__x", F.split(fields, MARK))
    plain = lambda c: F.replace(F.replace(c, F.lit(ESCAPE + OWN_MARK), F.lit(MARK)), F.lit(ESCAPE + OWN_ESCAPE), F.lit(ESCAPE))
    base = base.withColumn("__x", F.when(F.col("__safe") != F.col("__in"), F.transform("__x", plain)).otherwise(F.col("__x")))
    x = lambda k: F.get("__x", F.lit(k))
    f = F.col("__f")
    one_space = lambda c: F.regexp_replace(c, r"\s+", " ")
    comma_t = F.try_to_timestamp(x(0), F.lit("yyyy-MM-dd'T'HH:mm:ss,SSS"))
    comma_s = F.try_to_timestamp(one_space(x(0)), F.lit("yyyy-MM-dd HH:mm:ss,SSS"))
    dot_s = lambda c: F.try_to_timestamp(one_space(c), F.lit("yyyy-MM-dd HH:mm:ss.SSS"))
    zulu = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(x(0), "Z$", ""), r"\.(\d\d)$", ".$10"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))
    local = F.when(f.isin("PIPE_8FIELD", "SPRING", "PLAIN"), comma_t).when(f.isin("RUNNABLE_HIST", "AGENT"), comma_s).when(f == "REST_OPS", dot_s(x(0))).when(f == "PLAIN_Z", zulu)
    base = base.withColumns({"__local": local, "__end": F.when(f == "REST_OPS", dot_s(x(1)))})
    bad = f.isNotNull() & (F.col("__local").isNull() | ((f == "REST_OPS") & F.col("__end").isNull()))
    base = base.withColumn("bad_time", bad)
    ok = f.isNotNull() & ~F.col("bad_time")
    tail = F.when(f == "PIPE_8FIELD", x(7)).when(f == "AGENT", x(3))
    spring_logger = F.regexp_replace(F.when(F.contains(x(2), F.lit(":")), after_first(x(2), ":")).otherwise(F.lit("")), r"@\d+$", "")
    history = strip(x(2))
    command = strip(x(6))
    word = strip(x(1))
    level = (
        F.when(f.isin("PIPE_8FIELD", "SPRING", "AGENT"), F.when(word.isin(*LEVELS), word).otherwise("UNKNOWN"))
        .when(f == "RUNNABLE_HIST", F.when(history.rlike("FAILED|INOPERATIVE"), "ERROR").when(F.contains(history, F.lit("DOWN")), "WARN").otherwise("INFO"))
        .when(f == "REST_OPS", F.when(F.contains(F.upper(command), F.lit("FAILED")), "ERROR").otherwise("INFO"))
        .otherwise("UNKNOWN")
    )
    only = lambda name, c: F.when(f == name, c)
    columns = {
        "ts": F.when(f == "PLAIN_Z", F.col("__local")).otherwise(local_to_utc(F.col("__local"), tz_mode)),
        "level": level,
        "instance_id": only("PIPE_8FIELD", nonempty(x(2))),
        "tenant": only("PIPE_8FIELD", nonempty(x(3))),
        "session_id": only("PIPE_8FIELD", nonempty(x(4))),
        "request_id": only("PIPE_8FIELD", nonempty(x(5))),
        "thread": F.when(f == "PIPE_8FIELD", nonempty(x(6))).when(f == "SPRING", nonempty(F.split_part(x(2), F.lit(":"), F.lit(1)))).when(f == "AGENT", nonempty(x(2))).when(f == "REST_OPS", F.concat(x(4), F.lit("@"), x(5))),
        "logger": F.when(f.isin("PIPE_8FIELD", "AGENT"), nonempty(before_first(tail, " - "))).when(f == "SPRING", nonempty(spring_logger)).when(f == "REST_OPS", F.lit("REST_OPS")),
        "message": F.when(f.isin("PIPE_8FIELD", "AGENT"), strip(after_first(tail, " - "))).when(f == "SPRING", strip(x(3))).when(f == "RUNNABLE_HIST", history).when(f == "REST_OPS", F.concat(F.lit("["), x(2).cast("long").cast("string"), F.lit("ms] "), command)).otherwise(strip(x(1))),
        "content_runnable": only("RUNNABLE_HIST", strip(x(1))),
        "duration_ms": only("REST_OPS", F.try_to_number(x(2), F.lit("9999999999999")).cast("long")),
        "end_ts": only("REST_OPS", local_to_utc(F.col("__end"), tz_mode)),
    }
    out = base.withColumns({n: F.when(ok, c) for n, c in columns.items()})
    kind = F.when(ok, F.when(F.col("__wrapped"), "WRAPPER").when(f.isin("PLAIN", "PLAIN_Z"), "PLAIN_TS").otherwise(f))
    return out.withColumn("format_type", kind).drop("__raw", "__in", "__safe", "__wrapped", "__f", "__x", "__local", "__end")


def line_kind(parsed: DataFrame, line: str = "line", product: str | None = None) -> tuple[Column, Column]:
    """(kind, text) of parsed lines: record; stack, a line of its stack trace; more, one that lengthens its message; drop."""
    text = F.regexp_replace(F.coalesce(F.col(line), F.lit("")), r"[\r\n]+$", "")
    added = unstructured_kind(text, product).isin("BUS", "OTHER") & (strip(text) != "")
    kind = F.when(F.col("format_type").isNotNull(), "record").when(is_continuation(text), "stack").when(added, "more").otherwise("drop")
    return kind, F.when(kind == "more", strip(text)).otherwise(text)


def finished(out: DataFrame) -> DataFrame:
    """Records with stack trace and message made of __stack and __more, the joined lines (null for none)."""
    message = F.concat_ws("\n", "message", "__more")
    out = out.withColumns({"stack_trace": F.col("__stack"), "message": F.when(F.col("__more").isNotNull(), message).otherwise(F.col("message"))})
    return out.withColumns({"has_stack_trace": F.coalesce(F.col("stack_trace") != "", F.lit(False)), "message_hash": message_hash(F.col("message"))}).drop("__stack", "__more")


def fold_lines(parsed: DataFrame, file: str = "source_file", number: str = "line_number", line: str = "line", product: str | None = None, piece: int = PIECE) -> DataFrame:
    """Records with the lines that follow them: continuation lines make the stack trace, other unstructured ones lengthen the message.

    Lines before a file's first record are dropped, as are mail traffic and banners. stack_trace keeps lines as they are,
    blank ones too; so one blank line gives an empty one, which counts as none. A file is dealt out by pieces of so many
    line numbers; where a piece begins within a record, that is the last one of the pieces before.
    """
    is_record = F.col("format_type").isNotNull()
    begun = F.when(is_record, F.col(number))
    pieces = parsed.select(file, F.floor(F.col(number) / piece).alias("__p"), begun.alias("__start")).groupBy(file, "__p").agg(F.max("__start").alias("__start"))
    before = F.max("__start").over(W.partitionBy(file).orderBy("__p").rowsBetween(W.unboundedPreceding, -1))  # a row a piece
    pieces = pieces.select(F.col(file).alias("__file"), "__p", before.alias("__before"))
    kind, text = line_kind(parsed, line, product)
    rows = parsed.withColumns({"__p": F.floor(F.col(number) / piece), "__kind": kind, "__text": text})
    within = W.partitionBy(file, "__p").orderBy(number).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("__own", F.max(begun).over(within))
    rows = rows.join(pieces, F.col(file).eqNullSafe(F.col("__file")) & (rows["__p"] == pieces["__p"]), "left").withColumn("__rid", F.coalesce("__own", "__before")).where("__rid IS NOT NULL AND __kind <> 'drop'")
    at = lambda k: F.array_sort(F.collect_list(F.when(F.col("__kind") == k, F.struct(F.col(number).alias("n"), F.col("__text").alias("t")))))
    fixed = [c for c in parsed.columns if c not in (file, line)]
    booleans = {c for c, kind in parsed.dtypes if kind == "boolean"}
    first = [(F.bool_or if c in booleans else F.max)(F.when(is_record, F.col(c))).alias(c) for c in fixed]
    out = rows.groupBy(file, "__rid").agg(*first, at("stack").alias("__s"), at("more").alias("__m"))
    joined = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda s: s["t"]), "\n"))
    return finished(out.withColumns({"__stack": joined("__s"), "__more": joined("__m")}).drop("__s", "__m")).drop("__rid", "bad_time")


def placed(out: DataFrame) -> DataFrame:
    """Records with their runnable (by hint, content, path), state and epoch."""
    hint = F.col("runnable_hint") if "runnable_hint" in out.columns else F.lit(None).cast("string")
    runnable = F.coalesce(F.nullif(hint, F.lit("")), "content_runnable", runnable_of(F.coalesce("source_path", "source_file"), F.col("instance_id"), F.col("thread")))
    return out.withColumns({"runnable": runnable, "state": new_state(F.col("message"), F.col("format_type")), "epoch": epoch(F.col("ts"))})


def records(lines: DataFrame, tz_mode: str = "approx", product: str | None = None, piece: int = PIECE) -> DataFrame:
    """Records of lines (source_file, source_path, runnable_hint, line_number, line): noise goes after numbering, before parsing."""
    parsed = parse_lines(lines.where(~is_noise(F.coalesce(F.col("line"), F.lit("")))), "line", tz_mode)
    return placed(fold_lines(parsed, product=product, piece=piece))


def parse_stats(lines: DataFrame, found: DataFrame) -> DataFrame:
    """One row: lines, noise, records, by format and level as maps, errors, records with stack traces."""
    a = lines.agg(F.count("*").alias("total_lines"), F.count_if(is_noise(F.coalesce(F.col("line"), F.lit("")))).alias("noise_lines"))
    count = lambda c: found.groupBy(c).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias(f"by_{c}"))
    b = found.agg(F.count("*").alias("records"), F.count_if(F.col("level").isin("ERROR", "FATAL")).alias("errors"), F.count_if("has_stack_trace").alias("with_stack_trace"))
    one = lambda d: d.withColumn("__one", F.lit(1))
    return one(a).join(one(b), "__one").join(one(count("format_type")), "__one").join(one(count("level")), "__one").drop("__one")
