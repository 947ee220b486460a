"""Stored JSON documents: run manifests, pointers to them, and the artifacts they list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ensemblage.functions import constants as K


def field(document: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(document, path, kind)


def type_of(value: Column) -> Column:
    """object, array, string, number, integer, boolean, null, or NULL where the field is absent."""
    shape = F.schema_of_variant(value)
    return (
        F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array")
        .when(shape == "STRING", "string").when(shape == "BIGINT", "integer").when(shape == "BOOLEAN", "boolean")
        .when(shape == "VOID", "null").when(shape.isNotNull(), "number")
    )


def pointers(texts: DataFrame) -> DataFrame:
    """Pointer texts to ``schema``, ``ok``, ``manifest_path`` and ``problem``; a missing ``ok`` is false."""
    text = F.trim("text")
    document = F.try_parse_json(text)
    read = texts.withColumns({"_text": text, "_doc": document})
    read = read.withColumns(
        {
            "schema": field(F.col("_doc"), "$.schema", "string"),
            "_path": field(F.col("_doc"), "$.manifest_path", "variant"),
            "ok": F.coalesce(field(F.col("_doc"), "$.ok", "boolean"), F.lit(False)),
        }
    )
    path = F.when(type_of(F.col("_path")) == "string", F.col("_path").try_cast("string"))
    problem = (
        F.when(F.col("_text") == "", "empty")
        .when(F.col("_doc").isNull(), "not_json")
        .when(type_of(F.col("_doc")) != "object", "not_an_object")
        .when(~F.coalesce(F.col("schema") == K.POINTER_TAG, F.lit(False)), "wrong_schema")
        .when(F.col("_path").isNull(), "no_manifest_path")
        .when(F.coalesce(path, F.lit("")) == "", "bad_manifest_path")
    )
    read = read.withColumns({"manifest_path": path, "problem": problem})
    good = F.col("problem").isNull()
    kept = [c for c in texts.columns if c != "text"]
    return read.select(
        *kept, *[F.when(good, F.col(c)).alias(c) for c in ("schema", "ok", "manifest_path")], "problem"
    )


def manifests(texts: DataFrame) -> DataFrame:
    """Manifest texts to one typed row each; the document itself stays as a variant column.

    A text that is no JSON object keeps its row: ``problem`` says what it is, and the fields are NULL.
    """
    read = texts.withColumn("doc", F.try_parse_json("text"))
    doc = F.col("doc")
    problem = F.when(doc.isNull(), "not_json").when(type_of(doc) != "object", "not_an_object")
    read = read.withColumn("problem", problem)

    def amount(path: str, kind: str, default: object) -> Column:
        return F.when(F.col("problem").isNull(), F.coalesce(field(doc, path, kind), F.lit(default).cast(kind)))

    schema = F.when(F.col("problem").isNull(), F.coalesce(F.nullif(field(doc, "$.schema", "string"), F.lit("")), F.lit(K.RESULT_TAG)))
    return read.select(
        "manifest_path",
        schema.alias("schema"),
        amount("$.ok", "boolean", False).alias("ok"),
        amount("$.step", "string", "").alias("step"),
        amount("$.created_at_unix", "bigint", 0).alias("created_at_unix"),
        amount("$.runtime_seconds", "double", 0.0).alias("runtime_seconds"),
        amount("$.cwd", "string", "").alias("cwd"),
        field(doc, "$.upstream.manifest_path", "string").alias("upstream_path"),
        field(doc, "$.upstream.schema", "string").alias("upstream_schema"),
        field(doc, "$.upstream.ok", "boolean").alias("upstream_ok"),
        F.to_json(field(doc, "$.inputs", "variant")).alias("inputs"),
        F.to_json(field(doc, "$.environment", "variant")).alias("environment"),
        "problem", "doc",
    )


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """All manifests below ``root``."""
    found = spark.read.option("wholetext", True).option("recursiveFileLookup", True)
    texts = found.option("pathGlobFilter", "manifest.json").text(root)
    return manifests(texts.select(F.col("_metadata.file_path").alias("manifest_path"), F.col("value").alias("text")))


def failures(read: DataFrame) -> DataFrame:
    """One row per recorded failure: its place, its error, and its other fields as a map of JSON texts."""
    listed = read.select("manifest_path", F.posexplode(field(F.col("doc"), "$.failures", "array<variant>")).alias("pos", "item"))
    item = F.col("item")
    as_text = F.when(type_of(item) == "string", item.try_cast("string"))
    return listed.select(
        "manifest_path", "pos", F.coalesce(as_text, field(item, "$.error", "string")).alias("error"), _others(item, ("error",)).alias("extra")
    )


def _others(item: Column, known: tuple[str, ...]) -> Column:
    """The fields of an object beyond the known ones, as a map of JSON texts; NULL if there are none."""
    fields = field(item, "$", "map<string,variant>")
    rest = F.transform_values(F.map_filter(fields, lambda name, _: ~name.isin(*known)), lambda _, value: F.to_json(value))
    return F.when(F.size(rest) > 0, rest)


def declared_tasks(read: DataFrame) -> DataFrame:
    """``manifest_path`` and ``n_tasks``, the size that a run's array declares; NULL where it declares none."""
    return read.select("manifest_path", field(F.col("doc"), "$.artifacts.array.n_tasks", "int").alias("n_tasks"))


#: Fields of an artifact that have columns of their own, under all their names.
ARTIFACT_FIELDS = ("path_abs", "path", "path_rel", "label", "format", "sha256", "index", "rel_energy_kcal", "rel_energy")


def artifacts(read: DataFrame) -> DataFrame:
    """One row per listed artifact of every bucket that is a list, whatever its name.

    A bare string is its path, older names of the path are accepted, and further fields are in ``extra``.
    """
    buckets = field(F.col("doc"), "$.artifacts", "map<string,variant>")
    listed = read.select("manifest_path", F.explode(buckets).alias("bucket", "listed"))
    item = F.col("item")
    items = field(F.col("listed"), "$", "array<variant>")
    rows = listed.select("manifest_path", "bucket", F.posexplode(items).alias("pos", "item"))
    as_path = F.when(type_of(item) == "string", item.try_cast("string"))
    paths = [F.nullif(field(item, f"$.{name}", "string"), F.lit("")) for name in ("path_abs", "path", "path_rel")]
    return rows.select(
        "manifest_path", "bucket", "pos",
        F.coalesce(as_path, *paths).alias("path_abs"),
        field(item, "$.label", "string").alias("label"),
        field(item, "$.format", "string").alias("format"),
        field(item, "$.sha256", "string").alias("sha256"),
        field(item, "$.index", "int").alias("index"),
        F.coalesce(
            field(item, "$.rel_energy_kcal", "double"), field(item, "$.rel_energy", "double")
        ).alias("energy_kcal"),
        _others(item, ARTIFACT_FIELDS).alias("extra"),
    )


def energy_files(listed: DataFrame) -> DataFrame:
    """Per manifest the first listed file that holds energies, by its label or its name."""
    is_energy = F.lower("label").contains("energies") | F.col("path_abs").endswith(".energies")
    wanted = listed.where((F.col("bucket") == "files") & F.col("path_abs").isNotNull() & F.coalesce(is_energy, F.lit(False)))
    return wanted.groupBy("manifest_path").agg(F.min_by("path_abs", "pos").alias("path_abs"))


def discover_conformers(listed: DataFrame) -> DataFrame:
    """Conformer records of the first bucket that has geometry files, with the kind of source.

    Record buckets give all their records; an ensemble file or a single geometry gives its first.
    """
    buckets = F.create_map(*[F.lit(x) for i, b in enumerate(K.CONFORMER_BUCKETS) for x in (b, i)])
    usable = listed.where(F.col("path_abs").endswith(".xyz")).withColumn("rank", buckets[F.col("bucket")])
    usable = usable.where(F.col("rank").isNotNull())
    first = usable.groupBy("manifest_path").agg(F.min(F.struct("rank", "pos")).alias("first"))
    joined = usable.join(first, "manifest_path")
    mode = F.when(F.col("rank") <= 2, "many").when(F.col("rank") == 3, "ensemble").otherwise("single")
    kept = joined.where((F.col("rank") == F.col("first.rank")) & ((F.col("rank") <= 2) | (F.col("pos") == F.col("first.pos"))))
    return kept.select("manifest_path", mode.alias("mode"), "bucket", "pos", "path_abs", "energy_kcal")
