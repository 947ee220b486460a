"""The same questions as SQL over the given tables; ``CTES`` mirrors the adapters."""

from __future__ import annotations

import re

from ensemblage.functions import constants as K

BETA = 1.0 / (K.R_KCAL_PER_MOL_K * K.ROOM_TEMPERATURE_K)


def r6(expr: str) -> str:
    """Rounded to six places, without a negative zero."""
    return f"(round({expr}, 6) + 0.0)"


CTES: dict[str, str] = {
    "thermo_in": """
        SELECT o_custkey AS ensemble_id, o_orderkey + 1 AS conf_idx,
               CASE WHEN o_orderstatus <> 'P' THEN -76.0::DOUBLE - o_totalprice * 1e-8 END AS e_high_eh,
               0.04::DOUBLE + (o_orderkey % 7) * 1e-4 AS g_minus_eel_low_eh,
               CASE WHEN o_orderkey % 2 = 0 THEN -75.96::DOUBLE - o_totalprice * 1e-8 END AS g_low_eh
        FROM orders""",
    "gibbs": """
        SELECT *, coalesce(e_high_eh + g_minus_eel_low_eh, g_low_eh) AS g FROM thermo_in""",
    "delta": f"""
        SELECT *, min(g) OVER (PARTITION BY ensemble_id) AS g_min,
               (g - min(g) OVER (PARTITION BY ensemble_id)) * {K.HARTREE_TO_KCAL}::DOUBLE AS dg
        FROM gibbs""",
    "weighted": f"""
        SELECT *, exp(-dg * {BETA}::DOUBLE) / sum(exp(-dg * {BETA}::DOUBLE)) OVER (PARTITION BY ensemble_id) AS w
        FROM delta""",
    "cumulated": """
        SELECT *, CASE WHEN dg IS NOT NULL THEN sum(w) OVER (
                   PARTITION BY ensemble_id, dg IS NULL ORDER BY dg, conf_idx
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cum
        FROM weighted""",
    "conformers": """
        SELECT o_custkey AS ensemble_id, o_orderkey + 1 AS conf_idx,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 1.0371319e-5 END AS energy_kcal
        FROM orders""",
    "conformers_all": """
        SELECT o_custkey AS ensemble_id, o_orderkey + 1 AS conf_idx, o_totalprice * 1.0371319e-5 AS energy_kcal
        FROM orders""",
    "observed": """
        SELECT o_custkey AS ensemble_id, l_orderkey + 1 AS conf_idx, lineitem.*,
               CASE l_returnflag WHEN 'A' THEN 'H' WHEN 'N' THEN 'C' ELSE 'O' END AS element
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "shieldings": """
        SELECT ensemble_id, conf_idx, l_linenumber AS atom_index, element,
               25.0::DOUBLE + l_extendedprice * 1.0371319e-4 AS sigma
        FROM observed""",
    "couplings": """
        SELECT ensemble_id, conf_idx, l_linenumber AS i, element AS elem_i, l_linenumber + 1 AS j,
               CASE l_linestatus WHEN 'O' THEN 'H' ELSE 'C' END AS elem_j,
               CASE WHEN l_tax < 0.07 THEN l_quantity * 0.30173917131::DOUBLE - 2.0 END AS j_total
        FROM observed""",
    "weights": "SELECT ensemble_id, conf_idx, w FROM weighted WHERE w IS NOT NULL",
    "sigma_users": """
        SELECT ensemble_id, count(*) AS n_used
        FROM (SELECT DISTINCT ensemble_id, conf_idx FROM shieldings) JOIN weights USING (ensemble_id, conf_idx)
        GROUP BY ensemble_id""",
    "sigma_means": """
        SELECT ensemble_id, atom_index, sum(w * sigma) / sum(w) AS sigma_avg,
               arg_min(element, (conf_idx, element)) AS element, max(n_used) AS n_used
        FROM shieldings JOIN weights USING (ensemble_id, conf_idx) JOIN sigma_users USING (ensemble_id)
        GROUP BY ensemble_id, atom_index""",
    "j_users": """
        SELECT ensemble_id, count(*) AS n_used
        FROM (SELECT DISTINCT ensemble_id, conf_idx FROM couplings) JOIN weights USING (ensemble_id, conf_idx)
        GROUP BY ensemble_id""",
    "j_means": """
        SELECT ensemble_id, i, j, sum(w * j_total) / sum(w) AS j_avg,
               arg_min(elem_i, (conf_idx, elem_i, elem_j)) AS elem_i,
               arg_min(elem_j, (conf_idx, elem_i, elem_j)) AS elem_j, max(n_used) AS n_used
        FROM couplings JOIN weights USING (ensemble_id, conf_idx) JOIN j_users USING (ensemble_id)
        WHERE j_total IS NOT NULL
        GROUP BY ensemble_id, i, j""",
    "shift_table": """
        SELECT ensemble_id, atom_index, element, sigma_avg, n_used,
               CASE element WHEN 'H' THEN (sigma_avg - 31.8447) / -1.0698::DOUBLE
                            WHEN 'C' THEN (sigma_avg - 187.25) / -1.0501::DOUBLE END AS delta_ppm,
               CASE element WHEN 'H' THEN 'cheshire (Wiitala/Hoye/Cramer 2006)' WHEN 'C' THEN 'cheshire' ELSE '' END
                   AS cal_source,
               CASE element WHEN 'H' THEN 'WP04' WHEN 'C' THEN 'wB97X-D' ELSE '' END AS cal_method,
               CASE element WHEN 'H' THEN '6-311++G(2d,p)' WHEN 'C' THEN '6-31G(d,p)' ELSE '' END AS cal_basis,
               'CHCl3' AS cal_solvent
        FROM sigma_means""",
    "coupling_table": """
        SELECT *, CASE WHEN hh THEN 0.9105::DOUBLE * j_avg + 0.21 END AS j_predicted,
               CASE WHEN hh THEN 'Bally Rablen 2011 (J. Org. Chem. 76, 4818)' ELSE '' END AS cal_source,
               CASE WHEN hh THEN 'mPW1PW91' ELSE '' END AS cal_method,
               CASE WHEN hh THEN 'pcJ-2' ELSE '' END AS cal_basis, 'CHCl3' AS cal_solvent
        FROM (SELECT *, elem_i = 'H' AND elem_j = 'H' AS hh FROM j_means)""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the named tables that it needs."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(sql: str, me: str | None = None) -> None:
        for name in known:
            if name != me and name not in needed and re.search(rf"\b{name}\b", sql):
                visit(known[name], name)
                needed.append(name)

    visit(body)
    recursive = "RECURSIVE " if any(re.search(rf"\b{n}\b", known[n]) for n in needed) else ""
    tables = ",\n".join(f"{n} AS ({known[n]})" for n in needed)
    return f"WITH {recursive}{tables}\n{body}" if needed else body
