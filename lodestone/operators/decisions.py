"""Decisions as JSON, folded to one shape; what can't be folded is recorded with its reason in the same pass.

Keys have aliases and the checks an order: of several faults the first one is told. Nothing is thrown: a decision that
can't be folded is a row of the second output, so both outputs together have as many rows as the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import shorten
from ..sources.revisions import Store

# The keys of decisions, claims and events, and the aliases of a claim's text in their order.
DECISION_KEYS = ("status", "evidence_level", "claims", "verified_evidence_refs", "events", "conclusion", "unresolved", "unresolved_items")
CLAIM_KEYS = ("text", "claim", "statement", "claim_text", "status", "evidence_refs", "qualification")
EVENT_KEYS = ("stage", "route", "status", "summary", "evidence_refs", "inspected_paths", "hit_count", "duration_ms", "accounting", "extensions")
CLAIM_TEXTS = ("text", "claim", "statement", "claim_text")

LIST, OBJECT = "array<variant>", "map<string,variant>"
CLAIM = "array<struct<ordinal:int,text:string,status:string,evidence_refs:array<string>,qualification:string>>"
#: What to do about a reason, by how it begins.
ADVICE = (("broken-json", "send-the-decision-again"), ("not-an-object", "send-the-decision-again"), ("unsupported-fields", "drop-or-rename-fields"), ("", "correct-and-finalize-again"))


def kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def as_list(v: Column) -> Column:
    """The elements of a variant that is a list, else null."""
    return F.when(kind(v).startswith("ARRAY"), F.try_variant_get(v, "$", LIST))


def as_object(v: Column) -> Column:
    return F.when(kind(v).startswith("OBJECT"), F.try_variant_get(v, "$", OBJECT))


def text_of(v: Column) -> Column:
    """A variant's text, if it is one."""
    return F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def solid(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, r"(?U)\s+", "") != "", F.lit(False))


def others(keys: Column, allowed: tuple[str, ...]) -> Column:
    return F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in allowed])))


def listed(label: Column | str, names: Column) -> Column:
    """The label and the names, or null where there are none."""
    return F.when(F.size(names) > 0, F.concat(F.lit(label) if isinstance(label, str) else label, F.lit(":"), F.array_join(names, ",")))


def numbered(what: str, i: Column, fault: str) -> Column:
    return F.concat(F.lit(f"{what}-"), (i + 1).cast("string"), F.lit(f"-{fault}"))


def first_of(reasons: Column) -> Column:
    return F.get(F.filter(reasons, lambda r: r.isNotNull()), F.lit(0))


def claim_fault(c: Column, i: Column) -> Column:
    fields = as_object(c)
    said = F.array(*[solid(text_of(fields[k])) for k in CLAIM_TEXTS])
    return F.coalesce(
        F.when(fields.isNull(), numbered("claim", i, "not-an-object")), listed(numbered("claim", i, "unsupported-fields"), others(F.map_keys(fields), CLAIM_KEYS)),
        F.when(~F.array_contains(said, True), numbered("claim", i, "without-text")), F.when(F.map_contains_key(fields, "evidence_refs") & as_list(fields["evidence_refs"]).isNull(), numbered("claim", i, "refs-not-a-list")))


def event_fault(e: Column, i: Column) -> Column:
    fields = as_object(e)
    extra = fields["extensions"]
    some = F.map_contains_key(fields, "extensions") & (kind(extra) != "VOID")
    inner = F.coalesce(as_object(extra), F.create_map().cast(OBJECT))
    clash = F.filter(F.array_intersect(F.map_keys(inner), F.map_keys(fields)), lambda k: F.to_json(F.struct(inner[k].alias("v"))) != F.to_json(F.struct(fields[k].alias("v"))))
    lists = [F.when(F.map_contains_key(fields, k) & as_list(fields[k]).isNull(), numbered("event", i, f"{k}-not-a-list")) for k in ("evidence_refs", "inspected_paths")]
    return F.coalesce(
        F.when(fields.isNull(), numbered("event", i, "not-an-object")), F.when(some & as_object(extra).isNull(), numbered("event", i, "extensions-not-an-object")),
        listed(numbered("event", i, "reserved-extensions"), F.array_sort(F.array_intersect(F.map_keys(inner), F.array(*[F.lit(k) for k in EVENT_KEYS])))), *lists,
        listed(numbered("event", i, "extension-conflicts"), F.array_sort(clash)))


def folded_claim(c: Column, i: Column) -> Column:
    fields = as_object(c)
    texts = [F.when(solid(text_of(fields[k])), text_of(fields[k])) for k in CLAIM_TEXTS]
    refs = F.transform(F.coalesce(as_list(fields["evidence_refs"]), F.array().cast(LIST)), lambda r: F.try_variant_get(r, "$", "string"))
    return F.struct((i + 1).cast("int").alias("ordinal"), shorten(F.coalesce(*texts), 4000).alias("text"), text_of(fields["status"]).alias("status"), refs.alias("evidence_refs"), text_of(fields["qualification"]).alias("qualification"))


def fold_decisions(rows: DataFrame, decision: str = "decision") -> DataFrame:
    """The rows with outcome (folded or failed), status, evidence_level, conclusion, unresolved, claims, n_events,
    verified_evidence_refs of those that fold, and reason and recommendation of those that don't."""
    v = F.try_parse_json(decision)
    parsed = rows.withColumn("__v", v).withColumn("__top", as_object(F.col("__v")))
    top = F.col("__top")
    has = lambda k: F.coalesce(F.map_contains_key(top, k), F.lit(False))
    given = F.when(has("unresolved_items"), top["unresolved_items"]).otherwise(top["unresolved"])
    parsed = parsed.withColumns({"__open": as_list(given), "__claims": as_list(top["claims"]), "__events": as_list(top["events"]), "__verified": as_list(top["verified_evidence_refs"])})
    same = F.to_json(F.struct(top["unresolved"].alias("v"))).eqNullSafe(F.to_json(F.struct(top["unresolved_items"].alias("v"))))
    named = has("unresolved") | has("unresolved_items")
    reason = F.coalesce(
        F.when(F.col("__v").isNull(), "broken-json"), F.when(top.isNull(), "not-an-object"), listed("unsupported-fields", others(F.map_keys(top), DECISION_KEYS)),
        F.when(has("unresolved") & has("unresolved_items") & ~same, "unresolved-conflict"), F.when(named & (F.col("__open").isNull() | F.exists("__open", lambda x: ~solid(text_of(x)))), "unresolved-not-texts"),
        F.when(has("claims") & F.col("__claims").isNull(), "claims-not-a-list"), first_of(F.transform("__claims", claim_fault)), F.when(has("events") & F.col("__events").isNull(), "events-not-a-list"),
        first_of(F.transform("__events", event_fault)), F.when(has("verified_evidence_refs") & F.col("__verified").isNull(), "verified-not-a-list"))
    judged = parsed.withColumn("reason", reason)
    fine = F.col("reason").isNull()
    strings = lambda c: F.transform(F.coalesce(c, F.array().cast(LIST)), lambda x: F.try_variant_get(x, "$", "string"))
    advice = F.lit(ADVICE[-1][1])
    for begin, what in reversed(ADVICE[:-1]):
        advice = F.when(F.startswith(F.col("reason"), F.lit(begin)), what).otherwise(advice)
    kept = {"status": text_of(top["status"]), "evidence_level": text_of(top["evidence_level"]), "conclusion": text_of(top["conclusion"]), "unresolved": strings(F.col("__open")), "claims": F.coalesce(F.transform("__claims", folded_claim), F.array().cast(CLAIM)), "n_events": F.coalesce(F.size("__events"), F.lit(0)), "verified_evidence_refs": strings(F.col("__verified"))}
    own = [c for c in rows.columns if c not in (*kept, "outcome", "reason", "recommendation")]
    return judged.select(*own, F.when(fine, "folded").otherwise("failed").alias("outcome"), *[F.when(fine, x).alias(c) for c, x in kept.items()], "reason", F.when(~fine, advice).alias("recommendation"))


def record_decisions(store: Store, rows: DataFrame, base: int | None = None) -> int:
    """Both outputs, written by one job in one revision: parts ``folded`` and ``failed`` of the table ``decisions``."""
    change = store.change(base)
    change.put_parts("decisions", fold_decisions(rows), "outcome")
    return change.publish()
