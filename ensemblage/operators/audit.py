"""Rules on stored documents. Each rule gives problem rows: where, which field, and what is wrong with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.functions import constants as K
from ensemblage.sources.documents import field, type_of

KINDS = {
    "string": "^STRING$", "int": "^BIGINT$", "number": "^(?:BIGINT|DOUBLE|FLOAT|DECIMAL)", "object": "^OBJECT", "list": "^ARRAY",
}
RECORD_FIELDS = (("index", "int"), ("path_abs", "string"), ("sha256", "string"))
OPTIONAL_RECORD_FIELDS = (
    ("label", "string"), ("format", "string"), ("energy_kcal", "number"), ("rel_energy_kcal", "number"),
    ("cluster_id", "int"), ("cluster_distance", "number"), ("rejected_reason", "string"), ("metrics", "object"),
)
ENSEMBLE_FIELDS = (("label", "string"), ("path_abs", "string"), ("sha256", "string"))
INPUT_FIELDS = (("method", "string"), ("n_input", "int"), ("n_accepted", "int"), ("n_rejected", "int"))


def problem(where: Column | str, name: str, code: str) -> Column:
    where = F.lit(where) if isinstance(where, str) else where
    return F.struct(where.alias("place"), F.lit(name).alias("field"), F.lit(code).alias("problem"))


def is_a(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike(KINDS[kind]), F.lit(False))


def checked(container: Column, where: Column | str, fields: Sequence[tuple[str, str]], required: bool) -> list[Column]:
    """For each field: missing (if required) or of the wrong kind."""
    rules = []
    for name, kind in fields:
        value = field(container, f"$.{name}", "variant")
        wrong = F.when(~is_a(value, kind), problem(where, name, "wrong_type"))
        missing = problem(where, name, "missing") if required else F.lit(None)
        rules.append(F.when(value.isNull(), missing).otherwise(wrong))
    return rules


def as_rows(documents: DataFrame, problems: Column) -> DataFrame:
    listed = documents.select("manifest_path", F.explode(problems).alias("p"))
    return listed.select("manifest_path", "p.place", "p.field", "p.problem")


def envelope_problems(texts: DataFrame) -> DataFrame:
    """Problems of the outer document: schema tag, required fields, recorded arguments, kinds of the buckets."""
    documents = texts.select("manifest_path", F.try_parse_json("text").alias("doc"))
    doc = F.col("doc")
    schema = field(doc, "$.schema", "variant")
    known = is_a(schema, "string") & schema.try_cast("string").isin(K.RESULT_TAG, K.LEGACY_RESULT_TAG)
    inputs, artifacts = field(doc, "$.inputs", "variant"), field(doc, "$.artifacts", "variant")
    required = [
        F.when(field(doc, f"$.{name}", "variant").isNull(), problem("manifest", name, "missing"))
        for name in ("ok", "cwd", "inputs", "artifacts", "failures")
    ]
    buckets = F.map_entries(field(doc, "$.artifacts", "map<string,variant>"))

    def bucket(entry: Column) -> Column:
        value = entry["value"]
        empty = type_of(value).isin("null") | F.coalesce(value.try_cast("string").isin("[]", "0", "false", ""), F.lit(False))
        bad = F.when(entry["key"] == "array", ~is_a(value, "object") & ~empty).otherwise(~is_a(value, "list"))
        named = F.struct(F.lit("artifacts").alias("place"), entry["key"].alias("field"), F.lit("wrong_type").alias("problem"))
        return F.when(bad, named)

    rules = F.array(
        F.when(~F.coalesce(known, F.lit(False)), problem("manifest", "schema", "unknown")),
        *required,
        F.when(is_a(inputs, "object") & field(inputs, "$.raw_argv", "variant").isNull(), problem("inputs", "raw_argv", "missing")),
        F.when(~is_a(artifacts, "object"), problem("manifest", "artifacts", "wrong_type")),
        F.when(~is_a(field(doc, "$.failures", "variant"), "list"), problem("manifest", "failures", "wrong_type")),
    )
    in_buckets = F.when(is_a(artifacts, "object"), F.transform(buckets, bucket)).otherwise(F.array())
    found = F.array_compact(F.concat(rules, in_buckets))
    return as_rows(documents, F.when(~is_a(doc, "object"), F.array(problem("manifest", "", "not_an_object"))).otherwise(found))


def screen_problems(texts: DataFrame, require_reason: bool = True) -> DataFrame:
    """Problems of a screening run's document with the contract of its role."""
    documents = texts.select("manifest_path", F.try_parse_json("text").alias("doc"))
    doc = F.col("doc")
    inputs, artifacts = field(doc, "$.inputs", "variant"), field(doc, "$.artifacts", "variant")
    listed = {
        name: field(doc, f"$.artifacts.{name}", "array<variant>") for name in ("accepted", "rejected", "xyz_ensemble", "xyz")
    }
    documents = documents.select(
        "manifest_path", "doc", inputs.alias("inputs"), artifacts.alias("artifacts"),
        *[F.coalesce(v, F.array().cast("array<variant>")).alias(f"{k}_items") for k, v in listed.items()],
        *[is_a(field(doc, f"$.artifacts.{k}", "variant"), "list").alias(f"{k}_listed") for k in listed],
    )
    some = F.size("accepted_items") > 0
    has_inputs = is_a(F.col("inputs"), "object")

    def records(bucket: str) -> Column:
        def one(record: Column, place: Column) -> Column:
            where = F.concat(F.lit(f"{bucket}["), place.cast("string"), F.lit("]"))
            index = field(record, "$.index", "bigint")
            rules = [
                *checked(record, where, RECORD_FIELDS, True),
                F.when(is_a(field(record, "$.index", "variant"), "int") & (index < 1), problem(where, "index", "below_one")),
                *checked(record, where, OPTIONAL_RECORD_FIELDS, False),
            ]
            if bucket == "rejected":
                relative = field(record, "$.rel_energy_kcal", "variant").isNotNull()
                rules.append(F.when(relative, problem(where, "rel_energy_kcal", "only_for_accepted")))
                if require_reason:
                    no_reason = field(record, "$.rejected_reason", "variant").isNull()
                    rules.append(F.when(no_reason, problem(where, "rejected_reason", "missing")))
            listed_rules = F.array_compact(F.array(*rules))
            return F.when(is_a(record, "object"), listed_rules).otherwise(F.array(problem(where, "", "not_an_object")))

        return F.flatten(F.transform(f"{bucket}_items", one))

    def count(name: str, bucket: str) -> Column:
        value = field(F.col("inputs"), f"$.{name}", "variant")
        differs = is_a(value, "int") & (value.try_cast("bigint") != F.size(f"{bucket}_items"))
        return F.when(differs, problem("inputs", name, "disagrees_with_bucket"))

    indices = F.transform("accepted_items", lambda r: F.when(is_a(field(r, "$.index", "variant"), "int"), field(r, "$.index", "bigint")))
    all_known = F.forall(indices, lambda i: i.isNotNull())

    def single(bucket: str, label: str) -> list[Column]:
        items = F.col(f"{bucket}_items")
        first = F.get(items, F.lit(0))
        text = field(first, "$.label", "variant")
        present = some & (F.size(items) > 0)
        place = f"{bucket}[0]"
        inner = [F.when(present & is_a(first, "object"), rule) for rule in checked(first, place, ENSEMBLE_FIELDS, True)]
        return [
            F.when(some & (F.size(items) == 0), problem("artifacts", bucket, "missing")),
            F.when(present & ~is_a(first, "object"), problem(place, "", "not_an_object")),
            *inner,
            F.when(present & is_a(text, "string") & (text.try_cast("string") != label), problem(place, "label", "wrong_label")),
            F.when(present & (F.size(items) > 1), problem("artifacts", bucket, "more_than_one")),
        ]

    chosen = field(F.col("inputs"), "$.best_chosen_by", "variant")
    method = field(F.col("inputs"), "$.method", "variant")
    failures = field(doc, "$.failures", "array<variant>")
    ok = field(doc, "$.ok", "variant")
    flat = F.array_compact(F.array(
        F.when(~has_inputs, problem("manifest", "inputs", "missing")),
        *[F.when(has_inputs, rule) for rule in checked(F.col("inputs"), "inputs", INPUT_FIELDS, True)],
        F.when(has_inputs & is_a(method, "string") & (method.try_cast("string") == "auto"), problem("inputs", "method", "not_resolved")),
        *[F.when(~F.col(f"{b}_listed"), problem("artifacts", b, "missing")) for b in ("accepted", "rejected")],
        F.when(has_inputs, count("n_accepted", "accepted")), F.when(has_inputs, count("n_rejected", "rejected")),
        F.when(some & all_known & (F.array_sort(indices) != indices), problem("accepted", "index", "not_ascending")),
        F.when(some & all_known & (F.size(F.array_distinct(indices)) < F.size(indices)), problem("accepted", "index", "not_unique")),
        *single("xyz_ensemble", "accepted_ensemble"), *single("xyz", "best"),
        F.when(some & has_inputs & chosen.isNull(), problem("inputs", "best_chosen_by", "missing")),
        F.when(some & has_inputs & chosen.isNotNull() & ~is_a(chosen, "string"), problem("inputs", "best_chosen_by", "wrong_type")),
        F.when(~some & is_a_true(ok), problem("manifest", "ok", "true_without_accepted")),
        F.when(~some & (F.coalesce(F.size(failures), F.lit(0)) < 1), problem("manifest", "failures", "missing")),
    ))
    # without artifacts nothing beyond the inputs can be checked
    bare = F.array_compact(F.array(
        F.when(~has_inputs, problem("manifest", "inputs", "missing")),
        *[F.when(has_inputs, rule) for rule in checked(F.col("inputs"), "inputs", INPUT_FIELDS, True)],
        F.when(has_inputs & is_a(method, "string") & (method.try_cast("string") == "auto"), problem("inputs", "method", "not_resolved")),
        problem("manifest", "artifacts", "missing"),
    ))
    full = F.concat(flat, records("accepted"), records("rejected"))
    found = F.when(is_a(F.col("artifacts"), "object"), full).otherwise(bare)
    return as_rows(documents, F.when(~is_a(doc, "object"), F.array(problem("manifest", "", "not_an_object"))).otherwise(found))


def is_a_true(value: Column) -> Column:
    return F.coalesce((type_of(value) == "boolean") & value.try_cast("boolean"), F.lit(False))


def status_with_failures(manifests: DataFrame, failures: DataFrame) -> DataFrame:
    """A run with any failure is not ok, whatever it recorded; nor is one that can't be read."""
    counted = failures.groupBy("manifest_path").agg(F.count("*").alias("n_failures"))
    joined = manifests.select("manifest_path", "ok").join(counted, "manifest_path", "left").fillna(0, ["n_failures"])
    return joined.withColumn("ok", F.coalesce("ok", F.lit(False)) & (F.col("n_failures") == 0))
