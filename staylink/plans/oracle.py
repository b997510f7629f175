"""DuckDB SQL that recomputes each registered query independently.

These strings are the correctness oracle: the same listing view, then plain
SQL (CTEs, window functions, regexes in RE2 syntax).  They are written
against the pre-registered parquet views and never touch Spark.
"""

from __future__ import annotations

from ..sources.tables import LISTING_VIEW_SQL

LISTINGS = f"listings AS ({LISTING_VIEW_SQL.strip()})"


def present(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '\\S'), false)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def licence_ctes(src: str, out: str, col: str = "licencia") -> str:
    """CTEs adding _license_norm, licencia_letras, licencia_numeros to ``src``."""
    esf = r"ESFCTU\d+([A-Z]+)[/\s]*(\d+)"
    return f"""
{out}_a AS (SELECT *, regexp_replace({strip(f'upper({col})')}, '[,/]\\s*(?:19|20)\\d{{2}}', '', 'g') AS _ls FROM {src}),
{out}_b AS (SELECT *, regexp_extract(_ls, 'L(\\d+[A-Z]?\\d*)', 1) AS _lp FROM {out}_a),
{out}_c AS (SELECT * EXCLUDE (_ls, _lp), CASE
   WHEN {col} IS NULL THEN ''
   WHEN regexp_matches(_ls, '{esf}') THEN regexp_extract(_ls, '{esf}', 1) || regexp_extract(_ls, '{esf}', 2)
   WHEN _lp <> '' THEN 'L' || CASE WHEN regexp_extract(_lp, '(\\d+)$', 1) <> '' THEN regexp_extract(_lp, '(\\d+)$', 1)
                                   ELSE regexp_replace(_lp, '[^0-9]', '', 'g') END
   ELSE regexp_replace(_ls, '[^A-Z0-9]', '', 'g') END AS _lic_clean FROM {out}_b),
{out}_d AS (SELECT *,
   CASE WHEN regexp_matches(_lic_clean, '([A-Z]+)(\\d+)') THEN regexp_extract(_lic_clean, '([A-Z]+)(\\d+)', 1)
        WHEN regexp_matches(_lic_clean, '(\\d+)([A-Z]+)') THEN regexp_extract(_lic_clean, '(\\d+)([A-Z]+)', 2) END AS _lt,
   CASE WHEN regexp_matches(_lic_clean, '([A-Z]+)(\\d+)') THEN regexp_extract(_lic_clean, '([A-Z]+)(\\d+)', 2)
        WHEN regexp_matches(_lic_clean, '(\\d+)([A-Z]+)') THEN regexp_extract(_lic_clean, '(\\d+)([A-Z]+)', 1) END AS _ln
   FROM {out}_c),
{out}_e AS (SELECT * EXCLUDE (_lt, _ln), CASE
   WHEN _lic_clean = '' THEN ''
   WHEN _lt IS NULL THEN _lic_clean
   WHEN contains(_lt, 'A') OR contains(_lt, 'H') THEN _lt || _ln
   WHEN contains(_lt, 'E') THEN 'ETV' || _ln
   WHEN contains(_lt, 'V') AND contains(_lt, 'T') THEN 'VT' || _ln
   ELSE _lt || _ln END AS _license_norm FROM {out}_d),
{out} AS (SELECT *, nullif(regexp_extract(_license_norm, '^([A-Za-z]+)', 1), '') AS licencia_letras,
                 nullif(regexp_extract(_license_norm, '(\\d+)$', 1), '') AS licencia_numeros FROM {out}_e)"""


def title_norm(x: str, null_text: str = "nan") -> str:
    s = f"regexp_replace(lower(coalesce({x}, '{null_text}')), '[^a-z0-9\\s]', ' ', 'g')"
    return strip(f"regexp_replace({s}, '\\s+', ' ', 'g')")


def fold_title(x: str) -> str:
    s = f"regexp_replace(strip_accents(lower(coalesce({x}, ''))), '[^\\x00-\\x7F]', '', 'g')"
    return strip(f"regexp_replace({s}, '\\s+', ' ', 'g')")


def host_norm(x: str) -> str:
    return f"lower({strip(f'coalesce({x}, {chr(39)}nan{chr(39)})')})"


def haversine(lat1, lng1, lat2, lng2, r=6371.0) -> str:
    return (f"(2.0 * {r} * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2.0), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lng2}) - radians({lng1})) / 2.0), 2))))")


def grouping_ctes(src: str, out: str, key: str, host: str, by: list[str], row_suffix: bool,
                  anchor: str = "first") -> str:
    """CTEs assigning group_id per (by.., key) as group_by_licence_host does."""
    ks = ", ".join(by + [key])
    on = " AND ".join(f"s.{c} = t.{c}" for c in by + [key])
    row = f"'ROW_' || CAST(s.row_id AS VARCHAR)" + (f" || '_' || CAST(s.{key} AS VARCHAR)" if row_suffix else "")
    medoid = ""
    anchor_expr = "t.dom_first"
    if anchor == "medoid":
        on_m = " AND ".join(f"s.{c} = m.{c}" for c in by + [key])
        medoid = f""",
{out}_nul AS (SELECT {ks}, max(CASE WHEN lat IS NULL OR lng IS NULL THEN 1 ELSE 0 END) AS has_null FROM {src} GROUP BY {ks}),
{out}_pts AS (SELECT {ks}, lat AS plat, lng AS plng, count(*) AS w FROM {src} GROUP BY {ks}, lat, lng),
{out}_cand AS (SELECT s.* FROM {src} s JOIN {out}_ks t ON {on} JOIN {out}_nul n ON {" AND ".join(f"s.{c} = n.{c}" for c in by + [key])}
               WHERE t.max_rep >= 2 AND n.has_null = 0 AND s.{host} = t.dom_host),
{out}_sum AS (SELECT c.row_id, {", ".join(f"c.{c}" for c in by + [key])},
               sum(p.w * {haversine('c.lat', 'c.lng', 'p.plat', 'p.plng')}) AS dsum
               FROM {out}_cand c JOIN {out}_pts p ON {" AND ".join(f"c.{c} = p.{c}" for c in by + [key])}
               GROUP BY c.row_id, {", ".join(f"c.{c}" for c in by + [key])}),
{out}_med AS (SELECT {ks}, row_id AS anchor_row FROM (SELECT *, row_number() OVER (PARTITION BY {ks}
               ORDER BY round(dsum, 6), row_id) AS rn FROM {out}_sum) WHERE rn = 1)"""
        anchor_expr = "coalesce(m.anchor_row, t.dom_first)"
        join_m = f" LEFT JOIN {out}_med m ON {on_m}"
    else:
        join_m = ""
    return f"""
{out}_kh AS (SELECT {ks}, {host}, count(*) AS host_rows, min(row_id) AS first_row FROM {src} GROUP BY {ks}, {host}),
{out}_rk AS (SELECT *, row_number() OVER (PARTITION BY {ks} ORDER BY host_rows DESC, first_row) AS rn FROM {out}_kh),
{out}_ks AS (SELECT {ks}, max(host_rows) AS max_rep, count(*) AS n_hosts,
             max(CASE WHEN rn = 1 THEN {host} END) AS dom_host, max(CASE WHEN rn = 1 THEN first_row END) AS dom_first
             FROM {out}_rk GROUP BY {ks}){medoid},
{out} AS (SELECT s.*, CASE
   WHEN t.max_rep = 1 THEN CASE WHEN t.n_hosts > 1 THEN 'LIC_' || CAST(s.{key} AS VARCHAR) || '_ALL' ELSE {row} END
   WHEN s.{host} <> t.dom_host OR s.row_id = {anchor_expr} THEN 'LIC_' || CAST(s.{key} AS VARCHAR) || '_ANCH'
   ELSE {row} END AS group_id
   FROM {src} s JOIN {out}_ks t ON {on}{join_m})"""
