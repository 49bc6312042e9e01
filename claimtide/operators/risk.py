"""Refined favourability of intermediate-risk prostate orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import first_match, translate, true_only


def risk_rule(gleason: Column, psa: Column, stage: Column, original: Column) -> Column:
    """Decision table on Gleason score, PSA and clinical stage; first match wins.

    A missing PSA fails every limit and so ends as unfavorable.
    """
    favorable, unfavorable = F.lit(rules.FAVORABLE), F.lit(rules.UNFAVORABLE)
    below_10, below_20 = true_only(psa < 10), true_only(psa < 20)
    by_stage = (F.when(stage == "", original)
                .when(stage.isin(*rules.LOW_STAGES), favorable).otherwise(unfavorable))
    return first_match([
        (gleason == "", original),
        (gleason == "4+3", unfavorable),
        ((gleason == "3+3") & below_10, favorable),
        ((gleason == "3+3") & below_20, by_stage),
        (gleason == "3+3", unfavorable),
        ((gleason == "3+4") & below_10, by_stage),
        (gleason == "3+4", unfavorable),
    ])


def refine_risk(oli: DataFrame, revised: DataFrame | None = None,
                since: str = "2017-06-01") -> DataFrame:
    """Favourability for prostate orders delivered since a date at intermediate risk.

    ``revised``: oli_id, test, revised_risk as captured on the order.  The
    revised value wins where it is one of the two standard ones, else the
    decision table applies.  ``source_risk`` keeps the submitted value.
    """
    if revised is not None:
        oli = oli.join(revised.select("oli_id", "test", "revised_risk"), ["oli_id", "test"], "left")
    source = F.col("submitted_risk")
    wanted = true_only((F.col("delivered_dt") >= F.lit(since).cast("date"))
                       & (F.col("test") == "Prostate") & (source == "Intermediate Risk"))
    captured = translate("revised_risk", rules.REVISED_RISK)
    computed = risk_rule(F.coalesce("gleason", F.lit("")), F.col("psa"),
                         F.coalesce("stage", F.lit("")), source)
    known = true_only(captured.isin(rules.FAVORABLE, rules.UNFAVORABLE))
    refined = F.when(known, captured).otherwise(computed)
    return (oli.withColumns({
        "source_risk": source,
        "submitted_risk": F.when(wanted, refined).otherwise(source),
        "reporting_group": F.when(wanted, F.concat(F.lit("NCCN - "), refined))
                            .otherwise(F.col("reporting_group")),
    }).drop("revised_risk"))


def standardise_reporting_group(oli: DataFrame) -> DataFrame:
    """Micromets take the node status as group; AR-V7 tests get their own."""
    group = F.col("reporting_group")
    return oli.withColumn("reporting_group", F.when(F.col("test") == "Prostate-AR-V7", "ARV7")
                          .when(group == "Node Positive (Micromet)", F.col("nodal_status"))
                          .otherwise(group))
