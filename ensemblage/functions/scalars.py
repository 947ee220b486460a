"""Lenient parsing and canonical names as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ensemblage.functions import constants as K
from ensemblage.functions.tables import word_map

INTEGER = r"^[+-]?\d+$"
FLOAT = r"(?i)^[+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?$"


def folded(text: Column) -> Column:
    return F.lower(F.trim(text))


def named(text: Column, words: dict[str, object]) -> Column:
    """The canonical name of a word, or NULL."""
    return F.try_element_at(word_map(words), text)


def rounded(value: Column, places: int) -> Column:
    """A double rounded as SQL engines do it, by its scaled value, halves away from zero.

    ``F.round`` goes by the decimal digits, which noise of a sum may leave just below a half: 0.00000049999999 instead of 0.0000005.
    """
    scale = 10.0**places
    return F.round(value * scale) / scale


def parse_int(text: Column, default: Column | int) -> Column:
    value = folded(text)
    return F.coalesce(F.when(value.rlike(INTEGER), value.try_cast("int")), F.lit(default))


def parse_float(text: Column, default: Column | float) -> Column:
    value = folded(text)
    return F.coalesce(F.when(value.rlike(FLOAT), value.cast("double")), F.lit(default))


def parse_bool(text: Column, default: Column | bool) -> Column:
    value = folded(text)
    known = F.when(value.isin(*K.TRUE_WORDS), True).when(value.isin(*K.FALSE_WORDS), False)
    return F.coalesce(known, F.lit(default))


def tri_state(text: Column, default: str = "auto") -> Column:
    value = folded(text)
    known = (
        F.when(value.isin("auto", ""), "auto").when(value.isin(*K.TRI_TRUE_WORDS), "true")
        .when(value.isin(*K.TRI_FALSE_WORDS), "false")
    )
    return F.coalesce(known, F.lit(default))


def optional_int(text: Column) -> Column:
    value = folded(text)
    return F.when(value.rlike(INTEGER), value.try_cast("int"))


def optional_text(text: Column) -> Column:
    return F.when(~folded(text).isin(*K.NULL_WORDS), F.trim(text))


def key_problem(key: Column) -> Column:
    """Why a configuration key is refused, or NULL."""
    trimmed = F.trim(key)
    return (
        F.when(key.isNull(), "missing_key").when(trimmed == "", "empty_key")
        .when(trimmed != key, "whitespace_in_key").when(~key.rlike(r"^[A-Za-z_][A-Za-z0-9_-]*$"), "invalid_key")
    )


def config_problem(tokens: Column) -> Column:
    """Why a list of ``key=value`` tokens, or a single JSON object, cannot be read; NULL if it can."""
    only = F.trim(F.get(tokens, F.lit(0)))
    is_object = (F.size(tokens) == 1) & only.startswith("{") & only.endswith("}")
    is_list = (F.size(tokens) == 1) & only.startswith("[") & only.endswith("]")
    key = F.transform(tokens, lambda t: F.trim(F.split(t, "=", 2)[0]))
    letters = F.transform(key, lambda k: F.regexp_replace(k, "[_-]", ""))
    return (
        F.when(is_object, F.when(F.try_parse_json(only).isNull(), "bad_json"))
        .when(is_list, "json_array")
        .when(F.exists(tokens, lambda t: ~t.contains("=")), "no_equals_sign")
        .when(F.exists(key, lambda k: k == ""), "empty_key")
        .when(F.exists(letters, lambda k: ~k.rlike(r"^[\p{L}\p{N}]+$")), "bad_key")
    )


def config_map(tokens: Column) -> Column:
    """Tokens to a map of text, split at the first ``=``; a later token of the same key wins. NULL if unreadable."""
    only = F.trim(F.get(tokens, F.lit(0)))
    is_object = (F.size(tokens) == 1) & only.startswith("{") & only.endswith("}")
    pairs = F.transform(
        tokens, lambda t: F.struct(F.trim(F.split(t, "=", 2)[0]).alias("k"), F.trim(F.get(F.split(t, "=", 2), F.lit(1))).alias("v"))
    )
    keys = F.transform(pairs, lambda p: p["k"])
    last = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["k"]))
    built = F.map_from_entries(last)
    parsed = F.from_json(only, "map<string,string>")
    return F.when(config_problem(tokens).isNull(), F.when(is_object, parsed).otherwise(built))


def smd_solvent(text: Column) -> Column:
    """Known solvent names in their canonical spelling, others as they are, blank ones NULL."""
    return F.coalesce(named(folded(text), K.SMD_NAMES), F.nullif(F.trim(text), F.lit("")))


def alpb_solvent(text: Column) -> Column:
    value = folded(text)
    return F.when(value.isin(*K.ALPB_NAMES), value)


def alpb_problem(text: Column) -> Column:
    value = folded(text)
    fine = value.isNull() | value.isin("", *K.ALPB_VACUUM) | value.isin(*K.ALPB_NAMES)
    return F.when(~fine, "unknown_alpb_solvent")


def cpcm_solvent(text: Column) -> Column:
    value = folded(text)
    return F.when(value.isin(*K.CPCM_NAMES), F.coalesce(named(value, K.CPCM_CANONICAL), value))


def cpcm_problem(text: Column) -> Column:
    value = folded(text)
    fine = value.isNull() | value.isin("", *K.CPCM_VACUUM) | value.isin(*K.CPCM_NAMES)
    return F.when(~fine, "unknown_cpcm_solvent")


def xtb_theory(text: Column) -> Column:
    return named(F.coalesce(folded(text), F.lit("")), K.XTB_THEORIES)


def crest_theory(text: Column) -> Column:
    return named(F.coalesce(folded(text), F.lit("")), K.CREST_THEORIES)


def goat_theory(text: Column) -> Column:
    """Known aliases in canonical form, any other text trimmed unless it has forbidden characters."""
    alias = named(F.coalesce(folded(text), F.lit("")), K.GOAT_THEORIES)
    return F.coalesce(alias, F.when(~F.trim(text).rlike(K.GOAT_FORBIDDEN), F.trim(text)))


def opt_level(text: Column) -> Column:
    value = F.coalesce(folded(text), F.lit(""))
    return F.when(value == "", "tight").when(value.isin(*K.OPT_LEVELS), value)


def goat_mode(text: Column) -> Column:
    return named(F.coalesce(folded(text), F.lit("")), K.GOAT_MODES)


def functional_keyword(text: Column) -> Column:
    value = F.trim(F.coalesce(text, F.lit("")))
    return F.coalesce(named(F.lower(value), K.FUNCTIONAL_KEYWORDS), value)


def is_3c_composite(text: Column) -> Column:
    """One of the words is a composite method; hyphens join words, so a name may stand inside a longer one."""
    words = F.split(F.lower(text), r"[^a-z0-9ω-]+")
    return F.coalesce(F.exists(words, lambda w: any_of([F.contains(F.concat(F.lit("-"), w, F.lit("-")), F.lit(f"-{name}-")) for name in K.COMPOSITE_3C])), F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _operation_tokens(text: Column) -> Column:
    """The words of a calculation list: a JSON form, a JSON list, or words between commas."""
    value = F.trim(text)
    form = F.from_json(value, "map<string,boolean>")
    chosen = F.transform(
        F.filter(F.map_entries(form), lambda e: F.coalesce(e["value"], F.lit(False)) & e["key"].isin(*K.OPERATION_LABELS)),
        lambda e: F.try_element_at(word_map(K.OPERATION_LABELS), e["key"]),
    )
    listed = F.from_json(value, "array<string>")
    words = (
        F.when(F.coalesce(value, F.lit("")) == "", F.array(F.lit("optimize")))
        .when(value.startswith("{") & value.endswith("}"), chosen)
        .when(value.startswith("[") & value.endswith("]"), listed)
        .otherwise(F.split(value, ","))
    )
    return F.filter(F.transform(words, folded), lambda w: w != "")


def operations(text: Column) -> Column:
    """Canonical calculation kinds in run order, or NULL where a word is unknown."""
    found = F.transform(_operation_tokens(text), lambda w: named(w, K.OPERATION_ALIASES))
    known = F.filter(F.array(*[F.lit(o) for o in K.OPERATIONS]), lambda o: F.array_contains(found, o))
    return F.when(~F.exists(found, lambda w: w.isNull()), known)


def metric(text: Column) -> Column:
    return named(F.coalesce(folded(text), F.lit("")), K.METRIC_NAMES)


def clustering(text: Column) -> Column:
    return named(F.coalesce(folded(text), F.lit("")), K.CLUSTERING_NAMES)


def n_clusters(text: Column) -> Column:
    """A positive number, or NULL for automatic choice and for refused values (see ``n_clusters_problem``)."""
    value = optional_int(text)
    return F.when(value >= 1, value)


def n_clusters_problem(text: Column) -> Column:
    value = folded(text)
    automatic = value.isNull() | value.isin("", "auto")
    return F.when(~automatic & n_clusters(text).isNull(), "bad_n_clusters")


def multiplicity(explicit: Column, unpaired: Column) -> Column:
    return F.coalesce(explicit, unpaired + 1)


def safe_name(text: Column) -> Column:
    """A file-name stem of letters, digits, dots, dashes and single underscores."""
    value = F.translate(F.trim(F.coalesce(text, F.lit(""))), " ", "_")
    value = F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9._-]+", "_"), "_+", "_")
    value = F.regexp_replace(value, r"^[._-]+|[._-]+$", "")
    return F.when(value == "", "molecule").otherwise(value)


def stable_id(name: Column) -> Column:
    return F.conv(F.substring(F.sha1(F.encode(name, "UTF-8")), 1, 7), 16, 10).cast("bigint")


def spin_by_two(element: Column) -> Column:
    return F.coalesce(named(F.upper(element), K.SPIN_BY_TWO), F.lit(1))
