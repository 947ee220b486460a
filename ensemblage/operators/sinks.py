"""Result tables in their fixed column order, and how they are written."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ensemblage.functions import constants as K
from ensemblage.operators.thermo import standard_state_shift


def thermo_table(df: DataFrame, standard_state: str, temperature_k: float) -> DataFrame:
    """Rows of ``populations`` over picked outputs as the 19 columns of the thermochemistry table."""
    shift = standard_state_shift(standard_state, temperature_k)
    columns = (
        F.col("conf_idx"), F.col("task_dir"), F.col("thermo_out"), F.col("sp_out"), F.col("e_high_eh"),
        F.col("g_minus_eel_low_eh"), F.col("g_low_eh"), F.col("g_composite_eh"), F.col("delta_g_kcal"), F.col("weight"),
        F.col("weight") * 100.0, F.col("cum_weight"), F.col("cum_weight") * 100.0, F.lit(standard_state), F.lit(shift),
        F.lit(float(temperature_k)), F.col("t_low_k"), F.col("h_low_eh"), F.col("ts_corr_low_eh"),
    )
    return df.select("ensemble_id", *[c.alias(name) for c, name in zip(columns, K.THERMO_COLUMNS)])


def shifts_table(shifts: DataFrame) -> DataFrame:
    columns = (
        "atom_index", "element", "sigma_avg_ppm", "delta_ppm", "cal_source", "cal_method", "cal_basis", "cal_solvent", "n_used",
    )
    return shifts.select("ensemble_id", *[F.col(c).alias(name) for c, name in zip(columns, K.SHIFT_COLUMNS)])


def couplings_table(couplings: DataFrame) -> DataFrame:
    columns = (
        "i", "elem_i", "j", "elem_j", "j_avg_hz", "j_predicted_hz", "cal_source", "cal_method", "cal_basis", "cal_solvent", "n_used",
    )
    return couplings.select("ensemble_id", *[F.col(c).alias(name) for c, name in zip(columns, K.COUPLING_COLUMNS)])


def energy_line(index: Column, energy_eh: Column, relative_kcal: Column) -> Column:
    """Index, absolute and relative energy in fixed widths; NaN where there is none."""
    return (
        F.when(energy_eh.isNull(), F.format_string("%6d   NaN   NaN", index))
        .when(relative_kcal.isNull(), F.format_string("%6d   % .12f   NaN", index, energy_eh))
        .otherwise(F.format_string("%6d   % .12f   % .6f", index, energy_eh, relative_kcal))
    )


def relative_line(index: Column, relative_kcal: Column) -> Column:
    """Index and relative energy, for accepted conformers that have one."""
    return F.format_string("%6d  % .6f", index, relative_kcal)


def ensemble_frames(geometries: DataFrame) -> DataFrame:
    """Member geometries as the frames of one document per ensemble, each ended by a newline.

    The document is the frames in order; it stays a row per frame, so no ensemble has to fit a task.
    """
    text = F.col("text")
    return geometries.select(
        "ensemble_id", "conf_idx", F.when(text.endswith("\n"), text).otherwise(F.concat(text, F.lit("\n"))).alias("text")
    )


def thermo_summary(df: DataFrame, standard_state: str, temperature_k: float) -> DataFrame:
    """One JSON summary per ensemble."""
    shift = standard_state_shift(standard_state, temperature_k)
    counts = df.groupBy("ensemble_id").agg(
        F.count("*").alias("n_conformers"), F.count("g_composite_eh").alias("n_with_G"), F.min("g_composite_eh").alias("Gmin_eh")
    )
    fields = (
        F.col("n_conformers"), F.col("n_with_G"), F.col("Gmin_eh"), F.lit(temperature_k).alias("temperature_k"),
        F.lit(standard_state).alias("standard_state"), F.lit(shift).alias("std_state_corr_kcal"),
    )
    return counts.select("ensemble_id", F.to_json(F.struct(*fields)).alias("summary"))


def nmr_summary_json(summary: DataFrame) -> DataFrame:
    """One JSON text per ensemble of all columns of an NMR summary."""
    return summary.select("ensemble_id", F.to_json(F.struct(*[c for c in summary.columns if c != "ensemble_id"])).alias("summary"))


def write_table(df: DataFrame, path: str, order: list[str], file_format: str = "csv") -> None:
    """Write sorted by ensemble and ``order``, range partitioned so that a large ensemble spans several files.

    NULL becomes an empty cell; Spark's commit protocol makes the write all or nothing.
    """
    keys = ["ensemble_id", *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = ranged.write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    else:
        writer.format(file_format).save(path)


def write_lines(df: DataFrame, path: str, order: list[str], line: str = "text", separator: str = "\n") -> None:
    """Write one text column below ``path``, a folder per ensemble, sorted by ``order``.

    Frames that end in a newline take no separator of their own. A large ensemble spans several files, whose names
    are in order; ``read_lines`` gives the ensemble with each line.
    """
    keys = ["ensemble_id", *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.select("ensemble_id", line).write.mode("overwrite").partitionBy("ensemble_id").option("lineSep", separator).text(path)


def read_lines(spark: SparkSession, path: str, separator: str = "\n", ensemble_type: str = "string") -> DataFrame:
    """``ensemble_id`` and ``text`` of what ``write_lines`` wrote; folder names are read as ``ensemble_type``, so that "007" stays."""
    found = spark.read.schema(f"value string, ensemble_id {ensemble_type}").option("lineSep", separator).text(path)
    return found.select("ensemble_id", F.col("value").alias("text"))


def write_containers(df: DataFrame, path: str, order: list[str], line: str = "text", most_files: int = 64) -> None:
    """Write one text column of many ensembles into at most ``most_files`` sorted Parquet files, instead of a folder each.

    Rows are dealt by ranges of (ensemble, ``order``), so a large ensemble spans files and small ones share them. The ranges
    of ensembles of each row group stand in the files' footers, by which ``read_containers`` skips what it doesn't need.
    Spark's commit protocol puts a task's file in place only when the task has ended, and replaces the folder as a whole.
    """
    keys = ["ensemble_id", *order]
    place = F.struct(*order).alias("place") if len(order) > 1 else F.col(order[0]).alias("place")
    ranged = df.repartitionByRange(most_files, *keys).sortWithinPartitions(*keys)
    ranged.select("ensemble_id", place, F.col(line).alias("text")).write.mode("overwrite").parquet(path)


def read_containers(spark: SparkSession, path: str, ensembles: Sequence[Any] | None = None) -> DataFrame:
    """``ensemble_id``, ``place`` and ``text`` of what ``write_containers`` wrote, of all ensembles or of those named."""
    rows = spark.read.parquet(path)
    return rows if ensembles is None else rows.where(F.col("ensemble_id").isin(*ensembles))


def join_lines(rows: DataFrame, separator: str = "\n") -> DataFrame:
    """``ensemble_id`` and ``document``: the lines of each ensemble in order, for ensembles whose text fits a row."""
    listed = F.array_sort(F.collect_list(F.struct("place", "text")))
    return rows.groupBy("ensemble_id").agg(F.array_join(F.transform(listed, lambda r: r["text"]), separator).alias("document"))
