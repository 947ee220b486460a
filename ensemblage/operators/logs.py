"""Numbers out of log texts. Each file is parsed inside its own row by built-in expressions, so nothing is shuffled.

A file table has ``ensemble_id``, ``task_idx``, ``file_name`` and ``content``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ensemblage.functions import constants as K
from ensemblage.functions.scalars import any_of

FILE = ["ensemble_id", "task_idx", "file_name"]
NMR_FILE = r"^orca_nmr_[hcj]\.out$"


NUMERIC = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """Text to double; anything else, NaN included, to NULL.

    The pattern comes first because a failing cast raises and catches an exception per value.
    """
    return F.when(text.rlike(NUMERIC), text.cast("double"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def whole(digits: Column) -> Column:
    return let(digits, lambda d: F.when(d != "", d.try_cast("int")))


def last_marker(pattern: str) -> Column:
    """The number of the last match."""
    return number(F.try_element_at(F.regexp_extract_all("content", F.lit(pattern), F.lit(1)), F.lit(-1)))


def file_values(files: DataFrame) -> DataFrame:
    """The six last-match numbers of each file, how it ended and what it holds."""
    content = F.col("content")
    has_thermo = content.contains(K.THERMO_WORDS[0])
    for word in K.THERMO_WORDS[1:]:
        has_thermo = has_thermo | content.contains(word)
    tail = F.right(content, F.lit(K.TAIL_CHARS))
    return files.select(
        *FILE,
        *[last_marker(pattern).alias(name) for name, pattern in K.LOG_MARKERS.items()],
        tail.rlike(K.NORMAL_END).alias("ended_ok"),
        has_thermo.alias("has_thermo"),
        content.contains(K.ENERGY_WORDS).alias("has_energy"),
    )


def pick_outputs(values: DataFrame, sp_candidates: str = "no_nmr") -> DataFrame:
    """Per task the file for the thermochemistry and the file for the energy, with their numbers.

    The last file by name wins. NMR runs use another level of theory and are no source of energies
    unless ``sp_candidates`` is "all". Numbers travel with the choice, so no file is read twice.
    """
    if sp_candidates not in ("no_nmr", "all"):
        raise ValueError(f"sp_candidates must be no_nmr or all, got {sp_candidates!r}")
    row = F.struct("file_name", *K.LOG_MARKERS)
    allowed = F.lit(True) if sp_candidates == "all" else ~F.col("file_name").rlike(NMR_FILE)
    energy = F.col("has_energy") & allowed
    picked = values.groupBy("ensemble_id", "task_idx").agg(
        F.max(F.when(F.col("has_thermo"), row)).alias("thermo"),
        F.max(F.when(energy & ~F.col("has_thermo"), row)).alias("pure"),
        F.max(F.when(energy, row)).alias("any_energy"),
        F.max(row).alias("last"),
    )
    sp = F.coalesce("pure", "any_energy")
    picked = picked.withColumns({"thermo_row": F.coalesce(F.col("thermo"), sp, F.col("last")),
                                 "sp_row": F.coalesce(sp, F.col("thermo"), F.col("last"))})
    return picked.select(
        "ensemble_id", "task_idx",
        F.col("thermo_row.file_name").alias("thermo_out"),
        F.col("sp_row.file_name").alias("sp_out"),
        F.col("sp_row.final_energy_eh").alias("e_high_eh"),
        F.col("thermo_row.g_minus_eel_eh").alias("g_minus_eel_low_eh"),
        F.col("thermo_row.final_g_eh").alias("g_low_eh"),
        F.col("thermo_row.total_h_eh").alias("h_low_eh"),
        F.col("thermo_row.ts_corr_eh").alias("ts_corr_low_eh"),
        F.col("thermo_row.temperature_k").alias("t_low_k"),
    )


def over_roster(roster: DataFrame, picks: DataFrame) -> DataFrame:
    """One record per task of the roster; tasks without files have no numbers."""
    return roster.join(picks, ["ensemble_id", "task_idx"], "left")


def lines_of(text: Column) -> Column:
    return F.split(text, r"\r?\n")


def log_lines(files: DataFrame) -> DataFrame:
    return files.select(*FILE, F.posexplode(lines_of(F.col("content"))).alias("line_no", "line"))


def block_lines(files: DataFrame, header: str) -> DataFrame:
    """Lines by header-delimited block: ``block`` counts the headers up to there (0 before the first), ``pos`` the
    lines from the header on. ``header`` is a pattern without flags; case does not matter."""
    line = r"[^\n]*" + header

    def numbered(pieces: Column) -> Column:
        opens = pieces[0].rlike(r"(?i)^" + line).cast("int")

        def block(text: Column, piece: Column) -> Column:
            ended = F.when(piece < F.size(pieces) - 1, F.regexp_replace(text, r"\r?\n\z", "")).otherwise(text)
            return F.struct((piece + opens).alias("block"), ended.alias("text"))

        return F.transform(pieces, block)

    # exploded as an expression: of a column, its size would be filtered first, ahead of the spread over all cores
    cut = files.select(*FILE, F.inline(let(F.split("content", r"(?im)(?=^" + line + ")"), numbered)))
    return cut.select(*FILE, "block", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))


def keep_last(rows: str, same: Callable[[Column, Column], Column]) -> Column:
    """Of neighbours in a sorted array column that are the same, the last one."""
    listed = F.col(rows)
    return F.filter(listed, lambda x, i: (i == F.size(listed) - 1) | ~same(x, F.get(listed, i + 1)))


def shielding_rows(files: DataFrame) -> DataFrame:
    """Rows of the shielding summaries; where a file has several, the last one wins per atom."""

    def table_lines(block: Column) -> Column:
        # One letter per line: r is a row, t the title of another summary. The table is the first run of
        # rows, unless such a title stands before it.
        def mark(line: Column) -> Column:
            title = F.upper(line).contains("SUMMARY")
            return F.when(line.rlike(K.SHIELDING_LINE), "r").when(title, "t").otherwise(".")

        def first_run(lines: Column) -> Column:
            def cut(marks: Column) -> Column:
                before = F.length(F.regexp_extract(marks, r"^(\.*)(r+)", 1))
                return F.slice(lines, before + 1, F.length(F.regexp_extract(marks, r"^(\.*)(r+)", 2)))

            return let(F.array_join(F.transform(lines, mark), ""), cut)

        return let(F.slice(lines_of(block), 2, 1 << 30), first_run)

    def fields(line: Column, place: Column) -> Column:
        def named(tokens: Column) -> Column:
            return F.struct(
                tokens[0].cast("int").alias("atom_index"), place.alias("place"), tokens[1].alias("element"),
                tokens[2].cast("double").alias("sigma_iso_ppm"), tokens[3].cast("double").alias("sigma_aniso_ppm"),
            )

        return let(F.split(F.trim(line), r"\s+"), named)

    blocks = F.slice(F.split("content", K.SHIELDING_TITLE), 2, 1 << 30)
    listed = F.sort_array(F.transform(F.flatten(F.transform(blocks, table_lines)), fields))
    sorted_rows = files.select(*FILE, listed.alias("rows"))  # none of a file without a title, which no filter has to find first
    last = keep_last("rows", lambda x, y: x["atom_index"] == y["atom_index"])
    return sorted_rows.select(*FILE, F.explode(last).alias("r")).select(
        *FILE, "r.atom_index", "r.element", "r.sigma_iso_ppm", "r.sigma_aniso_ppm"
    )


def coupling_rows(files: DataFrame) -> DataFrame:
    """Pair blocks of the coupling section, three header styles; the last block of a pair wins as a whole.

    A block runs to the next header. In it the first value fills a term. Values marked with the pair's
    indices come from any line; spelled-out names only from lines without such a mark, and the cross
    term's line fills no other term.
    """
    nucleus = r"(\d+\s+[A-Z][a-z]?|[A-Z][a-z]?\s+\d+)"
    to_a = r"(?i)^Nucleus\s+A\s*[:=]\s*" + nucleus
    to_b = r"(?i)^(?:[^\n]*\n){0," + str(K.NUCLEUS_B_LINES) + r"}?[^\n]*?\bNucleus\s+B\s*[:=]\s*" + nucleus

    def ends(block: Column, place: Column) -> Column:
        return F.struct(
            place.alias("place"), F.regexp_extract(block, to_a, 1).alias("a"), F.regexp_extract(block, to_b, 1).alias("b"),
            F.regexp_replace(block, to_b + r"[^\n]*", "").alias("body"),
        )

    def head(block: Column) -> Column:
        def ordered(index: Column) -> Column:
            return F.struct(
                F.least(index[0], index[1]).alias("i"), F.greatest(index[0], index[1]).alias("j"), block["place"].alias("place"),
                (index[0] <= index[1]).alias("in_order"), F.regexp_extract(block["a"], "[A-Za-z]+", 0).alias("elem_a"),
                F.regexp_extract(block["b"], "[A-Za-z]+", 0).alias("elem_b"), block["body"].alias("body"),
            )

        return let(F.array(*[whole(F.regexp_extract(block[end], r"\d+", 0)) for end in "ab"]), ordered)

    blocks = F.transform(F.split("content", r"(?i)(?=\bNucleus\s+A\s*[:=])"), ends)
    blocks = F.filter(blocks, lambda b: (b["a"] != "") & (b["b"] != ""))
    listed = files.select(*FILE, F.sort_array(F.transform(blocks, head)).alias("pairs"))
    last = keep_last("pairs", lambda x, y: (x["i"] == y["i"]) & (x["j"] == y["j"]))
    pairs = listed.select(*FILE, F.explode(last).alias("p"))
    candidate = r"(?i)(?:\biso\s*=|[:=]\s*-?\d)"
    pairs = pairs.select(
        *FILE, "p.i", "p.j",
        F.when(F.col("p.in_order"), F.col("p.elem_a")).otherwise(F.col("p.elem_b")).alias("elem_i"),
        F.when(F.col("p.in_order"), F.col("p.elem_b")).otherwise(F.col("p.elem_a")).alias("elem_j"),
        F.filter(lines_of(F.col("p.body")), lambda line: line.rlike(candidate)).alias("lines"),
    )
    def hit(term: Column, value: Column) -> Column:
        return F.struct(term.alias("term"), value.alias("value"))

    def marked_hits(line: Column) -> Column:
        """Of each mark J[i,j](term): the term, and the value after "iso" if the indices are the pair's."""
        def one(mark: Column) -> Column:
            indices = F.transform(F.split(F.substring_index(mark, "]", 1), ","), lambda x: whole(F.trim(x)))
            term = F.trim(F.substring_index(F.substring_index(mark, ")", 1), "(", -1))
            text = F.regexp_extract(mark, r"(?i)\biso\s*=\s*([-+.0-9eE]+)", 1)
            mine = let(indices, lambda x: (F.size(x) == 2) & (F.array_min(x) == F.col("i")) & (F.array_max(x) == F.col("j")))
            return hit(F.upper(term), F.when(mine, let(text, number)))

        return F.transform(F.slice(F.split(line, r"(?i)J\["), 2, 1 << 30), one)

    def spelled_hits(line: Column) -> Column:
        """The line's labels and values: what stands before a colon or equals sign, and the number after it."""
        def named_term(label: Column) -> Column:
            return F.coalesce(*[
                F.when(any_of([F.contains(label, F.lit(f" {name} ")) for name in names]), term.upper()) for term, names in K.TERM_LABELS.items()
            ])

        def one(parts: Column, part: Column, place: Column) -> Column:
            label = F.concat(F.lit(" "), F.regexp_replace(F.lower(part), "[^a-z/]+", " "), F.lit(" "))
            value = F.regexp_extract(F.get(parts, place + 1), r"^\s*(" + K.NUMBER + ")", 1)
            return hit(let(label, named_term), let(value, lambda v: F.when(v != "", v.cast("double"))))

        def cross_or_all(found: Column) -> Column:
            return let(F.filter(found, lambda h: h["term"] == "SD/FC"), lambda cross: F.when(F.size(cross) > 0, cross).otherwise(found))

        found = let(F.split(line, "[:=]"), lambda parts: F.transform(parts, lambda part, place: one(parts, part, place)))
        return let(F.filter(found, lambda h: h["term"].isNotNull()), cross_or_all)

    def hits(line: Column) -> Column:
        return F.when(line.rlike(r"(?i)J\["), marked_hits(line)).otherwise(spelled_hits(line))

    names = dict(zip(K.COUPLING_TERMS, ("printed", "j_fc_hz", "j_sd_hz", "j_pso_hz", "j_dso_hz", "cross_hz")))

    def firsts(found: Column) -> Column:
        def first(term: str) -> Column:
            return F.get(F.filter(found, lambda h: h["term"] == term.upper()), F.lit(0))["value"]

        return F.struct(*[first(t).alias(n) for t, n in names.items()])

    found = F.filter(F.flatten(F.transform("lines", hits)), lambda h: h["value"].isNotNull())
    # exploded, so that a filter on a value is not pushed below and every line read again for it
    valued = pairs.select(*FILE, "i", "elem_i", "j", "elem_j", F.explode(F.transform(F.array(found), firsts)).alias("v"))
    valued = valued.select(*FILE, "i", "elem_i", "j", "elem_j", "v.*")
    return valued.select(
        *FILE, "i", "elem_i", "j", "elem_j",
        coupling_total().alias("j_total_hz"), "j_fc_hz", "j_sd_hz", "j_pso_hz", "j_dso_hz",
    )


def coupling_total() -> Column:
    """The printed total, else the sum of the four terms and the cross term if there is one."""
    terms = F.col("j_fc_hz") + F.col("j_sd_hz") + F.col("j_pso_hz") + F.col("j_dso_hz")
    return F.coalesce(F.col("printed"), terms + F.coalesce(F.col("cross_hz"), F.lit(0.0)))


def comment_energy(comment: Column) -> Column:
    """kcal/mol in a frame's comment: a named relative energy, else the first number unless it is in Hartree only.

    Units count whatever signs stand around them. Numbers inside words, such as "conf1", are no energies.
    """
    def value(words: Column) -> Column:
        named_at = F.array_position(words, F.lit(K.COMMENT_RELATIVE))
        after = F.when(named_at > 0, F.get(words, named_at.cast("int")))
        first = F.get(F.filter(F.transform(words, _leading_number), lambda n: n.isNotNull()), F.lit(0))
        return F.coalesce(_leading_number(after), F.when(let(F.split(F.lower(comment), "[^a-z]+"), in_kcal), first))

    def in_kcal(units: Column) -> Column:
        return ~F.arrays_overlap(units, F.array(*map(F.lit, ("eh", "hartree")))) | F.array_contains(units, "kcal")

    return let(F.split(F.trim(F.regexp_replace(comment, "[:=,;()]+", " ")), r"\s+"), value)


def _leading_number(word: Column) -> Column:
    """The number a word starts with; a unit may be joined to it."""
    return let(F.regexp_extract(word, "^[-+]?[0-9.]+([eE][-+]?[0-9]+)?", 0), number)
