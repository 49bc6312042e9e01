"""Payor policies: multi-select criteria, prior authorisation, coverage decision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide import rules
from claimtide.functions import blank_to_null, first_match, split_multi, translate, true_only
from claimtide.operators.lookup import as_lookup


@dataclass(frozen=True)
class Criterion:
    """A multi-select policy field with its label and the values it can hold."""

    field: str
    label: str
    values: tuple[str, ...]


def selected_flag(selected: Column, value: str | Column) -> Column:
    """'1' when selected, '0' when not, '' when the field is blank."""
    value = F.lit(value) if isinstance(value, str) else value
    return (F.when(selected.isNull(), "")
            .when(F.array_contains(selected, value), "1").otherwise("0"))


def criteria_wide(policy: DataFrame, criteria: Sequence[Criterion], header: Sequence[str],
                  test: str | None = None) -> DataFrame:
    """Policies of one test with a flag column ``field=value`` per possible value."""
    rows = policy if test is None else policy.filter(F.col("test") == test)
    return rows.select(
        *header, *[c.field for c in criteria],
        *[selected_flag(split_multi(F.col(c.field)), v).alias(f"{c.field}={v}")
          for c in criteria for v in c.values])


def _long(rows: DataFrame, criteria: Sequence[Criterion], header: Sequence[str], names: Sequence[str]) -> DataFrame:
    # One generated array per policy: the rows are expanded in place, in the
    # task that read them, and nothing is exchanged.
    crit, cond, cover = names
    items = [F.struct(F.lit(c.label).alias(crit), F.lit(v).alias(cond),
                      selected_flag(F.col(f"_{c.field}"), v).alias(cover))
             for c in criteria for v in c.values]
    split = rows.select(*header, *[split_multi(F.col(c.field)).alias(f"_{c.field}") for c in criteria])
    return split.select(*header, F.inline(F.array(*items)))


def criteria_long(policy: DataFrame, criteria: Mapping[str, Sequence[Criterion]],
                  header: Sequence[str]) -> DataFrame:
    """One row per policy and possible criterion value, for each test's criteria."""
    out = None
    for test, fields in criteria.items():
        part = _long(policy.filter(F.col("test") == test), fields, header,
                     ("criteria", "condition", "coverage"))
        out = part if out is None else out.unionByName(part)
    return out


def validation_wide(validation: DataFrame, header: Sequence[str], field: str = "prior_authorization",
                    requirements: Sequence[str] = rules.PA_REQUIREMENTS,
                    test: str | None = None) -> DataFrame:
    """Validations with one flag column per prior-authorisation requirement."""
    rows = validation if test is None else validation.filter(F.col("test") == test)
    selected = split_multi(F.col(field))
    return rows.select(*header, *[selected_flag(selected, r).alias(r) for r in requirements])


def validation_long(validation: DataFrame, header: Sequence[str], field: str = "prior_authorization",
                    requirements: Sequence[str] = rules.PA_REQUIREMENTS) -> DataFrame:
    """One row per validation and requirement, each exactly once."""
    crit = Criterion(field, field, tuple(requirements))
    return _long(validation, [crit], header, ("_field", "pa_requirement", "requirement")).drop("_field")


# policies against the enum table -------------------------------------------

# Conditions that a test may list; a table with more is no enum.
MOST_CONDITIONS = 2_000


def selections(rows: DataFrame, fields: Sequence[str]) -> Column:
    """All multi-select fields of a row as one map: field -> selected values, NULL for a blank field."""
    return F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.array(*[split_multi(F.col(f)) for f in fields]))


def _listed(enum: DataFrame, *columns: str) -> list:
    """Distinct rows of an enum table, sorted; read once while the plan is built."""
    found = enum.select(*columns).distinct().limit(MOST_CONDITIONS + 1).collect()
    if len(found) > MOST_CONDITIONS:
        raise ValueError(f"more than {MOST_CONDITIONS} conditions in the enum table")
    return sorted(found)


def criteria_long_listed(policy: DataFrame, enum: DataFrame, header: Sequence[str]) -> DataFrame:
    """One row per policy and condition that the enum table lists for its test: ``criteria, condition, coverage``.

    ``enum``: test, field, label, value.  The conditions of a test are one array, so each policy meets its own in a
    lookup by test and is expanded where it was read.  Fields that the policies don't have are left out, as are
    policies of tests without conditions.
    """
    known = enum.filter(F.col("field").isin(*policy.columns) & F.col("value").isNotNull() & F.col("test").isNotNull())
    fields = sorted({r.field for r in _listed(known, "field")})
    if not fields:
        return policy.limit(0).select(*header, *[F.lit("").alias(c) for c in ("criteria", "condition", "coverage")])
    conditions = known.groupBy(F.col("test").alias("_test")).agg(
        F.collect_set(F.struct("field", "label", "value")).alias("_conditions"))
    rows = policy.select("*", selections(policy, fields).alias("_selected")).join(
        as_lookup(conditions), F.col("test") == F.col("_test"))
    expanded = F.transform("_conditions", lambda c: F.struct(
        c["label"].alias("criteria"), c["value"].alias("condition"),
        selected_flag(F.try_element_at("_selected", c["field"]), c["value"]).alias("coverage")))
    return rows.select(*header, F.inline(expanded))


def criteria_wide_listed(policy: DataFrame, enum: DataFrame, header: Sequence[str], test: str) -> DataFrame:
    """Policies of one test with a flag column ``field=value`` per condition that the enum table lists for it."""
    listed = [r for r in _listed(enum.filter((F.col("test") == test) & F.col("value").isNotNull()), "field", "value")
              if r.field in policy.columns]
    fields = list(dict.fromkeys(r.field for r in listed))
    rows = policy.filter(F.col("test") == test)
    if not listed:
        return rows.select(*header)
    chosen = rows.select("*", selections(rows, fields).alias("_selected"))
    return chosen.select(*header, *fields, *[
        selected_flag(F.try_element_at("_selected", F.lit(r.field)), r.value).alias(f"{r.field}={r.value}") for r in listed])


def _requirements(enum: DataFrame, field: str) -> list[str]:
    rows = enum.filter((F.col("field") == field) & F.col("value").isNotNull())
    return [r.value for r in _listed(rows, "value")]


def validation_wide_listed(validation: DataFrame, enum: DataFrame, header: Sequence[str], test: str,
                           field: str = "prior_authorization") -> DataFrame:
    """``validation_wide`` with the requirements that the enum table (``field, value``) lists for the field."""
    return validation_wide(validation, header, field, _requirements(enum, field), test)


def validation_long_listed(validation: DataFrame, enum: DataFrame, header: Sequence[str],
                           field: str = "prior_authorization") -> DataFrame:
    """``validation_long`` with the requirements that the enum table (``field, value``) lists for the field."""
    return validation_long(validation, header, field, _requirements(enum, field))


# policy availability -------------------------------------------------------

def policy_of(policy: DataFrame, kind: str, criteria: Sequence[str]) -> DataFrame:
    """Policies of one kind (MP medical, CT contract), prefixed, with a blank mark."""
    p = kind.lower()
    blank = F.lit(True)
    for c in criteria:
        blank = blank & F.col(c).isNull()
    return (policy.filter((F.col("policy") == kind) & F.col("tier4_payor_id").isNotNull())
            .select("tier4_payor_id", "test", F.col("name").alias(f"{p}_policy"),
                    F.col("policy_status").alias(f"{p}_policy_status"),
                    blank.alias(f"_{p}_blank"),
                    *[F.col(c).alias(f"{p}_{c}") for c in criteria]))


def attach_policy(oli: DataFrame, policy: DataFrame, kind: str, criteria: Sequence[str],
                  wording: Mapping[str, str]) -> DataFrame:
    """Left join the plan's policy; status 'Blank PTC', 'No PTC' or 'Yes PTC' and its wording.

    A plan with several policies of a kind repeats the order line, as the
    policies differ.
    """
    p = kind.lower()
    out = oli.join(policy_of(policy, kind, criteria), ["tier4_payor_id", "test"], "left")
    status = first_match([(F.col(f"{p}_policy").isNull(), F.lit("No PTC")),
                          (F.col(f"_{p}_blank"), F.lit("Blank PTC"))], F.lit("Yes PTC"))
    return out.withColumns({
        f"{p}_status_detail": status,
        f"{p}_status": translate(status, wording, keep_unknown=False),
    }).drop(f"_{p}_blank")


def policy_availability(oli: DataFrame, policy: DataFrame, validation: DataFrame,
                        criteria: Sequence[str],
                        contract_wording: Mapping[str, str] = rules.POLICY_WORDING["CT"]) -> DataFrame:
    """Medical policy, contract and validation of every order line's plan."""
    out = attach_policy(oli, policy, "MP", criteria, rules.POLICY_WORDING["MP"])
    out = attach_policy(out, policy, "CT", criteria, contract_wording)
    dim = (validation.filter(F.col("tier4_payor_id").isNotNull())
           .select("tier4_payor_id", "test", F.col("name").alias("validation"), "pa_required"))
    return (out.join(dim, ["tier4_payor_id", "test"], "left")
            .withColumn("validation_available", F.when(F.col("validation").isNull(), "No").otherwise("Yes")))


# coverage ------------------------------------------------------------------

@dataclass(frozen=True)
class CoverageRule:
    """Patient column compared with a multi-select policy column.

    ``counted``: takes part in the decision.  ``only_when``: compare only for
    this patient value, any other is covered.
    """

    name: str
    patient: str
    policy: str
    counted: bool = True
    only_when: str | None = None


@dataclass(frozen=True)
class CoverageWords:
    inside: str = ".In"
    outside: str = "..Out"
    out_reason: str = "Out of criteria"


IBC_RULES = (
    CoverageRule("age_at_diagnosis", "patient_age", "mp_age_at_diagnosis"),
    CoverageRule("node_status", "nodal_status", "mp_node_status"),
    CoverageRule("er_status", "submitted_er", "mp_er_status"),
    CoverageRule("pr_status", "submitted_pr", "mp_pr_status"),
    CoverageRule("hormone_receptor", "hormone_receptor", "mp_hormone_receptor"),
    CoverageRule("her2_status", "submitted_her2", "mp_her2_status"),
    CoverageRule("procedure_type", "procedure_type", "mp_procedure_type"),
    CoverageRule("med_onc_order", "med_onc_order", "mp_med_onc_order"),
    CoverageRule("multi_tumour", "multiple_primaries", "mp_multi_tumour", only_when="Yes"),
)
PROSTATE_RULES = (
    CoverageRule("age_of_biopsy", "biopsy_age", "mp_age_of_biopsy"),
    CoverageRule("risk_category", "submitted_risk", "mp_risk_category"),
    CoverageRule("gleason_score", "gleason", "mp_gleason_score"),
    CoverageRule("clinical_stage", "stage", "mp_clinical_stage"),
    CoverageRule("procedure_type", "procedure_type", "mp_procedure_type"),
    CoverageRule("ctr", "is_hcp_ctr", "mp_ctr"),
    CoverageRule("med_onc_order", "med_onc_order", "mp_med_onc_order", counted=False),
    CoverageRule("tumour_involvement", "max_tumour_involvement", "mp_tumour_involvement", counted=False),
)
PROSTATE_WORDS = CoverageWords(out_reason="..Out")


def _cell(rule: CoverageRule):
    """Conditions of one criterion: (skipped, known, listed, member)."""
    value = F.coalesce(F.col(rule.patient), F.lit("Unknown"))
    listed = blank_to_null(rule.policy).isNotNull()
    known = ~value.isin("", "Unknown")
    member = true_only(F.array_contains(split_multi(rule.policy), value))
    skipped = F.lit(False) if rule.only_when is None else value != rule.only_when
    return skipped, known, listed, member


def coverage_in_out(data: DataFrame, coverage_rules: Sequence[CoverageRule],
                    words: CoverageWords = CoverageWords(),
                    status: str = "mp_status", detail: str = "mp_status_detail",
                    pre_claim: str = "pre_claim_failure",
                    failures: Sequence[str] = ("Failure", "PA Denied"),
                    failures_without_policy: Sequence[str] = ("Failure",)) -> DataFrame:
    """In/out decision per criterion, for the medical policy and for the order line.

    Without a policy everything is out.  Else a known patient value must be
    listed; a blank policy field is covered and not counted; an unknown patient
    value fails a filled field.  The policy decision needs at least one counted
    criterion; the order-line decision adds the prior authorisation.
    """
    no_policy = F.col(status) == "No policy"
    inside, outside = F.lit(words.inside), F.lit(words.outside)
    failure = F.coalesce(F.col(pre_claim), F.lit("PA not required"))
    columns, counted, passed = {}, [], []
    for rule in coverage_rules:
        skipped, known, listed, member = _cell(rule)
        ok = skipped | ~listed | (known & member)
        columns[f"{rule.name}_coverage"] = F.when(no_policy, outside).when(ok, inside).otherwise(outside)
        columns[f"{rule.name}_reason"] = first_match([
            (no_policy, F.col(detail)),
            (skipped, F.lit("Meet criteria")),
            (~listed, F.lit("Unspecified criteria")),
            (~known, F.lit("Indeterminable")),
            (member, F.lit("Meet criteria"))], F.lit(words.out_reason))
        columns[rule.policy] = (F.when(~no_policy & ~skipped & ~listed, "Unspecified criteria")
                                .otherwise(F.col(rule.policy)))
        if rule.counted:
            counts = ~skipped & listed
            counted.append(counts.cast("int"))
            passed.append((counts & ok).cast("int"))
    n, n_ok = sum(counted[1:], counted[0]), sum(passed[1:], passed[0])
    authorised = ~failure.isin(*failures)
    pa_ok = F.when(no_policy, ~failure.isin(*failures_without_policy)).otherwise(authorised)
    columns["pa_requirement_coverage"] = F.when(pa_ok, inside).otherwise(outside)
    columns["criteria_considered"] = F.when(~no_policy, n)
    columns["mp_in_criteria"] = F.when(~no_policy & (n > 0) & (n == n_ok), inside).otherwise(outside)
    columns["oli_in_criteria"] = F.when(~no_policy & (n == n_ok) & authorised, inside).otherwise(outside)
    columns[pre_claim] = failure
    if "pa_required" in data.columns:
        columns["pa_required"] = F.coalesce(F.col("pa_required").cast("string"), F.lit(".PTV unknown"))
    return data.withColumns(columns)


def coverage_in_out_strict(data: DataFrame, coverage_rules: Sequence[CoverageRule],
                           words: CoverageWords = CoverageWords("..In", ".Out"),
                           both_blank: str = "Patient & MP_Criteria blank",
                           status: str = "mp_status", pre_claim: str = "pre_claim_failure") -> DataFrame:
    """Stricter variant: a blank policy field is out when the patient value is known.

    Both missing is bypassed.  Every rule given counts; only 'Failure' fails the
    prior authorisation.
    """
    no_policy = F.col(status) == "No policy"
    inside, outside = F.lit(words.inside), F.lit(words.outside)
    columns, failed = {}, []
    for rule in coverage_rules:
        skipped, known, listed, member = _cell(rule)
        ok = skipped | (known & listed & member)
        bypass = ~skipped & ~known & ~listed
        columns[f"{rule.name}_coverage_2"] = first_match([
            (no_policy, outside), (bypass, F.lit(both_blank)), (ok, inside)], outside)
        failed.append(~(ok | bypass))
    failure = true_only(F.col(pre_claim) == "Failure")
    columns["pa_requirement_2"] = F.when(~no_policy, F.when(failure, outside).otherwise(inside))
    any_failed = failure
    for f in failed:
        any_failed = any_failed | f
    columns["mp_in_criteria_2"] = F.when(~no_policy & ~any_failed, inside).otherwise(outside)
    return data.withColumns(columns)
