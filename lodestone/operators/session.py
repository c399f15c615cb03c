"""Question sessions: guards before a start, limits of inspection and supplement, and the gate before an answer.

State is small and kept by the caller; sets of records are checked as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import questions
from ..model import CLAIM_STATUSES, MAX_INSPECTIONS, MAX_SUPPLEMENTS
from .trace import claim_violations, evidence_violations

DECISION_KEYS = ("answer", "claims", "evidence_level", "status", "notes", "verification")
CLAIM_KEYS = ("text", "claim", "statement", "claim_text", "status", "refs", "qualification")


def question_guard(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds violation where a text holds several questions, or none at all."""
    return rows.withColumn("violation", F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty-question").when(questions(text) >= 2, "several-questions"))


def unknown_keys(extensions: Column, allowed: tuple[str, ...]) -> Column:
    """Keys of a map that aren't allowed."""
    return F.array_sort(F.array_except(F.map_keys(extensions), F.array(*[F.lit(k) for k in allowed])))


@dataclass
class Session:
    """What one trace may still do."""

    trace_id: str
    inspections: int = 0
    supplements: int = 0
    evidence_dirty: bool = False
    log: list[str] = field(default_factory=list)

    def inspect(self) -> bool:
        """Whether another inspection is open; counts it."""
        if self.inspections >= MAX_INSPECTIONS:
            self.log.append("inspection-blocked")
            return False
        self.inspections, self.evidence_dirty = self.inspections + 1, False
        return True

    def supplement(self) -> bool:
        if not self.inspections or self.supplements >= MAX_SUPPLEMENTS:
            self.log.append("supplement-blocked")
            return False
        self.supplements, self.evidence_dirty = self.supplements + 1, True
        return True


def upsert_catalog(catalog: DataFrame, packets: DataFrame) -> DataFrame:
    """The catalogue after an inspection: a section keeps its handle, new ones get those after the highest; violation where a known
    section's document version changed. catalog: trace_id, handle_no, document_path, section_id, document_version."""
    keys = ["trace_id", "document_path", "section_id"]
    seen = packets.select(*keys, F.col("document_version").alias("__version"), F.col("rank").alias("__rank"))
    both = catalog.join(seen, keys, "full_outer")
    whole = Window.partitionBy("trace_id")
    new = F.col("handle_no").isNull()
    place = F.row_number().over(Window.partitionBy("trace_id", new).orderBy("__rank", "document_path", "section_id"))
    fresh = (F.coalesce(F.max("handle_no").over(whole), F.lit(0)) + place).cast("int")
    changed = F.col("handle_no").isNotNull() & F.col("__version").isNotNull() & (F.col("__version") != F.col("document_version"))
    return both.withColumn("violation", F.when(changed, "document-version-changed")).withColumn("handle_no", F.coalesce("handle_no", fresh)).withColumn("document_version", F.coalesce("__version", "document_version")).drop("__version", "__rank")


def decision_violations(claims: DataFrame, catalog: DataFrame) -> DataFrame:
    """trace_id, claim_no, violation: refs that the catalogue doesn't have, unknown statuses, blank texts.

    claims: trace_id, claim_no, text, status, refs (handles P1, P2, ...)."""
    handles = catalog.select("trace_id", F.concat(F.lit("P"), F.col("handle_no").cast("string")).alias("ref"))
    unknown = claims.select("trace_id", "claim_no", F.explode("refs").alias("ref")).join(handles, ["trace_id", "ref"], "left_anti").select("trace_id", "claim_no", F.lit("unknown-ref").alias("violation"))
    codes = F.array_compact(F.array(F.when(~F.col("status").isin(*CLAIM_STATUSES), "unknown-claim-status"), F.when(F.trim(F.coalesce("text", F.lit(""))) == "", "blank-claim"), F.when((F.col("status") == "supported") & (F.size("refs") == 0), "supported-needs-ref")))
    return unknown.unionByName(claims.select("trace_id", "claim_no", F.explode(codes).alias("violation"))).distinct()


def ready_to_finish(session: Session, evidence: DataFrame, claims: DataFrame) -> list[str]:
    """Codes of all that stands against finishing; they are few by kind, so they come to the driver."""
    found = evidence_violations(evidence).select("violation").unionByName(claim_violations(claims, evidence).select("violation")).distinct()
    return sorted(r.violation for r in found.collect()) + (["evidence-dirty"] if session.evidence_dirty else [])
