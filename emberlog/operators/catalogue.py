"""The built-in rule catalogue. Deployments load their own from YAML, see sources.rules."""

from __future__ import annotations

from dataclasses import replace

from emberlog.operators.detect import Catalogue, Escalation, Rule

ERR, ERR_FATAL = ("ERROR",), ("ERROR", "FATAL")
ARCM, ABS, BOTH = ("arcm_s",), ("abs_s",), ("abs_s", "arcm_s")

#: Ids, kinds, severities, patterns, filters, windows and thresholds of the rules.
DEFAULT = Catalogue(
    (
        Rule("C01", "Connection pool exhausted", "KEYWORD", "CRITICAL", "No free database connection", runnable_filter=ARCM, level_filter=ERR_FATAL, frequency_escalation=Escalation(10, 5, "P1"), tags=("database", "pool", "availability")),
        Rule("C02", "Database login failed", "REGEX", "CRITICAL", "Cannot open database.*login failed", runnable_filter=BOTH, level_filter=ERR_FATAL, tags=("database", "authentication", "availability")),
        Rule("C03", "Schema migration failed", "KEYWORD", "CRITICAL", "Cannot calculate migration", runnable_filter=ARCM, level_filter=ERR_FATAL, tags=("database", "schema", "startup")),
        Rule("C04", "Service inoperative", "KEYWORD", "CRITICAL", "INOPERATIVE", level_filter=ERR_FATAL, tags=("lifecycle", "crash", "availability")),
        Rule("C05", "Crash during shutdown", "KEYWORD", "CRITICAL", "BeanCreationNotAllowedException", runnable_filter=ARCM, level_filter=("FATAL",), tags=("spring", "lifecycle", "crash")),
        Rule("H01", "Null pointer in job monitoring", "REGEX", "HIGH", "NullPointerException.*JobMonitoringTag|JobMonitoringTag.*NullPointerException", runnable_filter=ARCM, level_filter=ERR, match_stack_trace=True, frequency_escalation=Escalation(3, 60, "CRITICAL"), tags=("application", "bug", "arcm")),
        Rule("H02", "Objects can't be loaded", "REGEX", "HIGH", "BUS-10507.*cannot load object", runnable_filter=ARCM, level_filter=ERR, frequency_escalation=Escalation(50, 10, "CRITICAL"), tags=("application", "data", "arcm")),
        Rule("H03", "Objects can't be saved", "REGEX", "HIGH", "BUS-10201.*cannot save objects", runnable_filter=ARCM, level_filter=ERR, tags=("application", "data", "arcm")),
        Rule("H04", "Export user's login failed", "KEYWORD", "HIGH", "Login failed for user BulkExport", runnable_filter=("arcm_s", "abs_s"), level_filter=ERR, tags=("authentication", "integration")),
        Rule("M01", "Database configuration", "KEYWORD", "MEDIUM", "Banca UBAE", runnable_filter=ABS, level_filter=("ERROR", "WARN"), tags=("configuration", "publishing")),
        Rule("M02", "Executor bean missing", "REGEX", "MEDIUM", "MBean.*Catalina.*httpExecutor|MBean.*Catalina.*ajpExecutor", level_filter=ERR, match_stack_trace=True, tags=("jmx", "startup", "monitoring")),
        Rule("M03", "Request parameter missing", "REGEX", "MEDIUM", "MissingServletRequestParameterException.*(?:dbName|selectedItemId)", runnable_filter=ABS, level_filter=("WARN",), tags=("application", "request")),
        Rule("M04", "Plugin properties missing", "KEYWORD", "MEDIUM", "Could not load properties for plugin", runnable_filter=ABS, level_filter=ERR, tags=("localization", "ui")),
        Rule("M05", "View can't be initialised", "REGEX", "MEDIUM", "BUS-10802.*cannot initialize view", runnable_filter=ARCM, level_filter=ERR, tags=("application", "ui", "arcm")),
        Rule("M06", "Internal exception", "REGEX", "MEDIUM", "BUS-10010.*internal exception", runnable_filter=ARCM, level_filter=ERR, tags=("application", "arcm")),
        Rule("M07", "No published database", "KEYWORD", "MEDIUM", "NO_PUBLISHED_DB_ACCESSIBLE", runnable_filter=ABS, level_filter=ERR, tags=("publishing", "configuration")),
        Rule("L01", "No registered instance", "KEYWORD", "LOW", "[ZKC] No registered Instance", level_filter=ERR, tags=("zookeeper", "startup", "noise")),
        Rule("L02", "Deactivated app type", "KEYWORD", "LOW", "Invalid apptype-specific info for app type APG", runnable_filter=("agent",), level_filter=ERR, tags=("apg", "deactivated", "noise")),
        Rule("L03", "Dependency versions differ", "KEYWORD", "LOW", "Netty dependencies have versions that do not match", runnable_filter=ABS, level_filter=("WARN",), tags=("dependency", "cosmetic")),
        Rule("L04", "Invalid token", "KEYWORD", "LOW", "Invalid RPC token (Invalid XSRF token)", runnable_filter=ABS, level_filter=ERR, tags=("session", "authentication", "noise")),
        Rule("S01", "Restart loop", "STATE_SEQUENCE", "CRITICAL", state_sequence=("STARTING", "DOWN", "STARTING", "DOWN", "STARTING"), window_minutes=10, tags=("lifecycle", "restart_loop", "availability")),
        Rule("S02", "Crash without recovery", "STATE_SEQUENCE", "HIGH", state_sequence=("STARTED", "DOWN"), window_minutes=5, no_followup_state="STARTING", tags=("lifecycle", "crash", "availability")),
        Rule("S03", "Slow shutdown", "STATE_SEQUENCE", "MEDIUM", state_sequence=("STARTED", "STOPPING"), window_minutes=3, no_followup_state="STOPPED", tags=("lifecycle", "shutdown")),
    )
)


def default(database: str = "") -> Catalogue:
    """The catalogue for a deployment whose main database has a name (C02); without one, any database counts."""
    pattern = f"Cannot open database.*{database}.*login failed" if database else "Cannot open database.*login failed"
    return Catalogue(tuple(replace(r, pattern=pattern) if r.rule_id == "C02" else r for r in DEFAULT.rules))
