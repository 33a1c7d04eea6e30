"""The whole chain over raw lines: parse, score, signatures and classifier, decision, and the second opinion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import detect as D
from ..operators import parse as P
from ..operators import review as R
from . import dfp

#: Columns of a parsed event that its results keep.
EVENT_COLUMNS = ["srcip", "dstip", "srcport", "dstport", "proto", "action", "app", "sentbyte", "rcvdbyte", "event_original", "@timestamp"]


def detect(lines: DataFrame, line: str = "value", tie: str = "event_id", **how) -> DataFrame:
    """Results of raw lines: the event, its behaviour scores and the threat decision, one row a line.

    Lines that hold no event have no entity and are judged by their text alone.
    """
    events = P.parse_firewall(lines, line).withColumn("ts", F.col("`@timestamp`").cast("timestamp"))
    scored = dfp.score(events, tie=tie, clock=F.col("ts"), keep=EVENT_COLUMNS, **how)
    return D.threat_result(D.cascade(scored.withColumn("text", D.detection_text(scored))))


def review(results: DataFrame, clock: str, tie: str = "event_id", **how) -> DataFrame:
    """Results with the second opinion: threshold, cooldown, and the analyst's verdict for the rows that pass both."""
    status = R.review_status(results, clock=clock, tie=tie, **how)
    asked = status.filter("llm_status = 'analyzed'")
    asked = R.attach_verdict(R.analyze(asked.withColumn("prompt", D.render_prompt(asked, "review")))).drop("prompt")
    return status.filter("llm_status <> 'analyzed'").unionByName(asked, allowMissingColumns=True)
