"""Oracle SQL per registered query (keys match :data:`catalog.QUERIES`)."""

from __future__ import annotations

from .oracle import LISTINGS, grouping_ctes, host_norm, fold_title, licence_ctes, present, title_norm

ORACLE: dict[str, str] = {}

HOSTED = f"""{LISTINGS},
hl0 AS (SELECT * FROM listings WHERE {present('anfitrion')} AND {present('licencia')}),{licence_ctes('hl0', 'hl1')},
hosted AS (SELECT *, {host_norm('anfitrion')} AS _host_norm FROM hl1)"""

ORACLE["canonical_license"] = f"""WITH {LISTINGS},{licence_ctes('listings', 'lic')}
SELECT row_id, licencia, _lic_clean, _license_norm, licencia_letras, licencia_numeros FROM lic"""

ORACLE["normalize_title"] = f"""WITH {LISTINGS}
SELECT row_id, {title_norm('nombre')} AS title_norm, {fold_title('nombre')} AS title_fold,
       {host_norm('anfitrion')} AS host_norm FROM listings"""

GROUPS = f"""{HOSTED},{grouping_ctes('hosted', 'g', '_license_norm', '_host_norm', ['plataforma'], True)}"""

ORACLE["group_by_licence_host"] = f"""WITH {GROUPS}
SELECT row_id, plataforma, _license_norm, _host_norm, group_id FROM g"""

ORACLE["licence_group_summary"] = f"""WITH {GROUPS},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plataforma, group_id ORDER BY row_id) AS rn FROM g) WHERE rn = 1)
SELECT plataforma, CASE WHEN ends_with(group_id, '_ALL') THEN 'ALL' WHEN ends_with(group_id, '_ANCH') THEN 'ANCH' ELSE 'ROW' END AS group_kind,
       count(*) AS groups, sum(capacidad) AS capacity, min(row_id) AS first_row_id
FROM f GROUP BY 1, 2"""


def _coverage(rows: list[tuple[str, str, str]], aggs: str) -> str:
    sel = " UNION ALL ".join(f"SELECT plataforma, '{m}' AS metric, CAST({c} AS BIGINT) AS count, CAST({s} AS DOUBLE) AS share FROM a"
                             for m, c, s in rows)
    return f"WITH {LISTINGS}, a AS (SELECT plataforma, {aggs} FROM listings GROUP BY plataforma) {sel}"


def _share(n, d):
    return f"round_even(100.0 * {n} / nullif({d}, 0), 2)"


ORACLE["host_coverage"] = _coverage(
    [("Total listings", "n", "100.0"), ("Listings without host", "n_missing", _share("n_missing", "n"))],
    f"count(*) AS n, count_if(NOT {present('anfitrion')}) AS n_missing")
ORACLE["hostless_licence_coverage"] = _coverage(
    [("Listings without host", "n_nohost", _share("n_nohost", "n")),
     ("…con número de licencia", "n_lic", _share("n_lic", "n_nohost"))],
    f"count(*) AS n, count_if(NOT {present('anfitrion')}) AS n_nohost, "
    f"count_if(NOT {present('anfitrion')} AND {present('licencia')}) AS n_lic")
ORACLE["usable_coverage"] = _coverage(
    [("Total listings", "n", "100.0"), ("Listings with host + license", "n_usable", _share("n_usable", "n"))],
    f"count(*) AS n, count_if({present('anfitrion')} AND {present('licencia')}) AS n_usable")

from .oracle import haversine, strip  # noqa: E402

EXCL_LETTERS = "('AG','AT','A','H','HA','HT','APM','PM','TI','HPM')"
EXCL_TYPES = ("('Hotel','Apartahotel','Agroturismo','Hostal o pensión','Apartotel','Complejo turístico',"
              "'Albergue','Resort','Suite','Aparthotel','Camping')")
R_INDEX = 6371.0088

ORACLE["holidu_cleanup"] = f"""WITH {LISTINGS}
SELECT row_id, plataforma, anfitrion,
       CASE WHEN plataforma = 'holidu' AND licencia = 'No proporcionado' THEN '' ELSE licencia END AS licencia
FROM listings WHERE NOT (plataforma = 'holidu' AND coalesce(regexp_matches(anfitrion, 'Vrbo|Booking.com'), false))"""

ORACLE["split_host_presence"] = f"""WITH {LISTINGS}
SELECT plataforma, count(*) AS rows, 'usable' AS subset FROM listings WHERE {present('anfitrion')} AND {present('licencia')} GROUP BY plataforma
UNION ALL
SELECT plataforma, count(*) AS rows, 'no_host' AS subset FROM listings WHERE NOT {present('anfitrion')} GROUP BY plataforma"""

ORACLE["class_filters"] = f"""WITH {LISTINGS},{licence_ctes('listings', 'lic')}
SELECT row_id, _license_norm, licencia_letras, licencia_numeros, tipo FROM lic
WHERE NOT (coalesce(licencia_letras IN {EXCL_LETTERS}, false) OR coalesce(contains(upper(licencia_letras), 'EDIFICI'), false))
  AND NOT coalesce(tipo IN {EXCL_TYPES}, false) AND capacidad IS NOT NULL"""

ORACLE["listing_projections"] = f"""WITH {LISTINGS},
u AS (SELECT *, 'https://www.airbnb.es/rooms/' || CAST(property_id AS VARCHAR) || '?check_in=2025-07-01&adults=2' AS url,
             regexp_extract(nombre, '^\\s*(\\S*)', 1) AS w FROM listings)
SELECT row_id, 'https://www.booking.com/hotel/es/' || CAST(property_id AS VARCHAR) || '.es.html' AS booking_url,
       'https://www.holidu.es/d/' || CAST(property_id AS VARCHAR) AS holidu_url,
       split_part(url, '?', 1) AS clean_url, regexp_extract(split_part(url, '?', 1), '([^/]*)$', 1) AS listing_id,
       CASE WHEN w = 'Casa' THEN 'Casa rural' WHEN w = 'Apto.' THEN 'Apartamento' ELSE w END AS derived_tipo,
       '2025-06-25' AS fecha, 'Entire home/apt' AS alojamiento, {present('anfitrion')} AS host_present
FROM u"""

ORACLE["parse_result_count"] = f"""WITH {LISTINGS},
c AS (SELECT plataforma, tipo, count(*) AS n FROM listings GROUP BY plataforma, tipo),
h AS (SELECT *, CASE WHEN tipo = 'Hotel' THEN NULL WHEN tipo = 'Finca' THEN 'No hay coincidencias exactas'
                     WHEN n > 1000 THEN 'Más de 1.000 alojamientos'
                     ELSE replace(format('{{:,}}', n), ',', '.') || ' alojamientos' END AS heading FROM c)
SELECT plataforma, tipo, n, heading,
       CASE WHEN heading IS NULL THEN -1 WHEN contains(heading, 'Más de') THEN 1000
            WHEN regexp_extract(heading, '(\\d[\\d.]*)', 1) <> '' THEN CAST(regexp_replace(regexp_extract(heading, '(\\d[\\d.]*)', 1), '[.\\s]', '', 'g') AS BIGINT)
            ELSE 0 END AS parsed FROM h"""

DEDUP_IN = f"""{LISTINGS},
di0 AS (SELECT * FROM listings WHERE {present('plataforma')} AND {present('licencia')}),{licence_ctes('di0', 'di1')},
di AS (SELECT *, {host_norm('plataforma')} AS _host_norm FROM di1),{grouping_ctes('di', 'pg', '_license_norm', '_host_norm', [], False, anchor='medoid')}"""

ORACLE["fill_defaults"] = f"""WITH {DEDUP_IN}
SELECT row_id, coalesce(anfitrion, 'host_desconocido') AS anfitrion, coalesce(tipo, 'tipo_desconocido') AS tipo,
       coalesce(plataforma, 'platform_desconocido') AS plataforma, coalesce(habitaciones, -1) AS habitaciones,
       coalesce(capacidad, -1) AS capacidad, coalesce(lat, 0.0) AS lat, coalesce(lng, 0.0) AS lng, group_id
FROM pg WHERE NOT coalesce(contains(group_id, 'ANCH'), false)"""

ORACLE["group_by_licence_platform"] = f"""WITH {DEDUP_IN}
SELECT row_id, _license_norm, _host_norm, group_id FROM pg"""

ORACLE["medoid_anchor"] = f"""WITH {DEDUP_IN}
SELECT _license_norm, anchor_row FROM pg_med
UNION ALL
SELECT t._license_norm, t.dom_first AS anchor_row FROM pg_ks t JOIN pg_nul n ON t._license_norm = n._license_norm
WHERE t.max_rep >= 2 AND n.has_null = 1"""

ORACLE["host_counts"] = f"""WITH {HOSTED}
SELECT plataforma, _license_norm, _host_norm, count(*) AS host_rows, min(row_id) AS first_row FROM hosted
GROUP BY plataforma, _license_norm, _host_norm"""

ISLANDS = """CASE WHEN lat BETWEEN 39.10129556224702 AND 40.17457797140084 AND lng BETWEEN 2.3739429649583883 AND 3.4572007960993005 THEN 'mallorca'
  WHEN lat BETWEEN 39.73202837261271 AND 40.183968810121 AND lng BETWEEN 3.8166048322976565 AND 4.306760466171312 THEN 'menorca'
  WHEN lat BETWEEN 38.76877967614272 AND 39.164966472991914 AND lng BETWEEN 1.19828131814009 AND 1.6218922749454237 THEN 'ibiza'
  WHEN lat BETWEEN 38.579720345013094 AND 38.77151823526658 AND lng BETWEEN 1.3865663541037065 AND 1.5908027388515222 THEN 'formentera' END"""

ORACLE["tag_island"] = f"WITH {LISTINGS} SELECT row_id, {ISLANDS} AS isla FROM listings"

ORACLE["snapshot_counts"] = f"""WITH {LISTINGS}, t AS (SELECT *, {ISLANDS} AS isla FROM listings)
SELECT plataforma, isla, count(*) AS rows, count_if(lat IS NULL OR lng IS NULL) AS no_coords FROM t GROUP BY plataforma, isla"""

ORACLE["radius_join"] = f"""WITH {LISTINGS},
p AS (SELECT * FROM listings WHERE lat IS NOT NULL AND lng IS NOT NULL AND capacidad IS NOT NULL AND habitaciones IS NOT NULL)
SELECT a.row_id AS i, b.row_id AS j, round({haversine('a.lat', 'a.lng', 'b.lat', 'b.lng', R_INDEX)}, 6) AS km
FROM p a JOIN p b ON a.plataforma = b.plataforma AND a.capacidad = b.capacidad AND a.habitaciones = b.habitaciones
 AND a.row_id < b.row_id AND abs(a.lat - b.lat) < 0.01
WHERE {haversine('a.lat', 'a.lng', 'b.lat', 'b.lng', R_INDEX)} <= 0.2"""

ORACLE["radius_join_model"] = f"""WITH {LISTINGS},
p AS (SELECT row_id, lat, lng, coalesce(capacidad, -1) AS capacidad, coalesce(habitaciones, -1) AS habitaciones
      FROM listings WHERE lat IS NOT NULL AND lng IS NOT NULL)
SELECT a.row_id AS i, b.row_id AS j, round({haversine('a.lat', 'a.lng', 'b.lat', 'b.lng', R_INDEX)}, 6) AS km
FROM p a JOIN p b ON a.capacidad = b.capacidad AND a.habitaciones = b.habitaciones
 AND a.row_id < b.row_id AND abs(a.lat - b.lat) < 0.01
WHERE {haversine('a.lat', 'a.lng', 'b.lat', 'b.lng', R_INDEX)} <= 0.5"""

MERGED = f"""{DEDUP_IN},
mb AS (SELECT row_id, licencia_numeros, lat, lng FROM pg WHERE licencia_letras IS NULL AND licencia_numeros IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL),
ml AS (SELECT row_id AS j, licencia_numeros, lat, lng, group_id AS gj FROM pg WHERE licencia_letras IS NOT NULL AND licencia_numeros IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL),
mm AS (SELECT b.row_id AS i, arg_max(l.gj, l.j) AS gnew FROM mb b JOIN ml l ON b.licencia_numeros = l.licencia_numeros
       WHERE {haversine('b.lat', 'b.lng', 'l.lat', 'l.lng')} <= 1.0 GROUP BY b.row_id),
merged AS (SELECT pg.* REPLACE (coalesce(mm.gnew, pg.group_id) AS group_id) FROM pg LEFT JOIN mm ON pg.row_id = mm.i)"""

ORACLE["merge_numeric_letter"] = f"""WITH {MERGED}
SELECT row_id, licencia_letras, licencia_numeros, group_id FROM merged"""

SPLIT = f"""{MERGED},
sp AS (SELECT row_id, group_id, lat, lng FROM merged WHERE group_id IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL),
se AS (SELECT a.row_id AS u, b.row_id AS v FROM sp a JOIN sp b ON a.group_id = b.group_id AND a.row_id <> b.row_id
       WHERE {haversine('a.lat', 'a.lng', 'b.lat', 'b.lng')} <= 2.0),
reach(node, lbl) AS (SELECT row_id, row_id FROM merged UNION SELECT se.v, r.lbl FROM reach r JOIN se ON se.u = r.node),
comp AS (SELECT node AS row_id, min(lbl) AS component FROM reach GROUP BY node),
lab AS (SELECT m.*, c.component FROM merged m JOIN comp c USING (row_id)),
cl AS (SELECT group_id, component, row_number() OVER (PARTITION BY group_id ORDER BY component) AS n,
              count(*) OVER (PARTITION BY group_id) AS k FROM (SELECT DISTINCT group_id, component FROM lab WHERE group_id IS NOT NULL)),
split AS (SELECT l.* REPLACE (CASE WHEN cl.k > 1 THEN l.group_id || '_LOC' || CAST(cl.n AS VARCHAR) ELSE l.group_id END AS group_id)
          FROM lab l LEFT JOIN cl ON l.group_id = cl.group_id AND l.component = cl.component)"""

ORACLE["split_groups_by_distance"] = f"""WITH RECURSIVE {SPLIT}
SELECT row_id, group_id FROM split"""

NOHOST = f"""nh0 AS (SELECT * FROM listings WHERE anfitrion IS NULL),{licence_ctes('nh0', 'nh1')},
nh AS (SELECT *, CAST(row_number() OVER (ORDER BY row_id) - 1 AS VARCHAR) || 'No_host' AS group_id, 'NA' AS _host_norm FROM nh1)"""

ORACLE["hostless_groups"] = f"""WITH {LISTINGS},{NOHOST}
SELECT row_id, group_id, _license_norm, _host_norm FROM nh"""

ORACLE["drop_hostless_known"] = f"""WITH RECURSIVE {SPLIT},
surv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY row_id) AS rn FROM split) WHERE rn = 1),{NOHOST}
SELECT row_id, group_id, _license_norm, _host_norm FROM nh
WHERE _license_norm NOT IN (SELECT _license_norm FROM surv WHERE _license_norm IS NOT NULL)"""

ORACLE["coverage_gaps"] = f"""WITH {LISTINGS}
SELECT row_id, plataforma FROM listings l WHERE NOT EXISTS (SELECT 1 FROM listings c WHERE c.lat IS NOT NULL AND c.row_id = l.row_id)"""

ORACLE["group_licence_flags"] = f"""WITH {GROUPS},
f AS (SELECT *, {present('licencia')} AS has_license FROM g)
SELECT row_id, has_license, bool_or(has_license) OVER (PARTITION BY plataforma, group_id) AS group_has_license,
       sum(CASE WHEN has_license THEN 0 ELSE 1 END) OVER (PARTITION BY plataforma, group_id) AS no_license_count FROM f"""

PGROUP = f"""{LISTINGS}, pgi AS (SELECT *, 'P' || CAST(property_id AS VARCHAR) AS group_id, {present('licencia')} AS has_license FROM listings),
pgf AS (SELECT *, bool_or(has_license) OVER (PARTITION BY plataforma, group_id) AS ghl,
               sum(CASE WHEN has_license THEN 0 ELSE 1 END) OVER (PARTITION BY plataforma, group_id) AS nlc FROM pgi)"""

ORACLE["drop_lone_unlicensed"] = f"""WITH {PGROUP}
SELECT row_id, group_id FROM pgf WHERE NOT (NOT has_license AND ghl AND nlc = 1)"""

ORACLE["drop_lone_unlicensed_by_host"] = f"""WITH {LISTINGS},
g AS (SELECT *, concat_ws('/', anfitrion, CAST(property_id % 97 AS VARCHAR), CAST(habitaciones AS VARCHAR)) AS group_id, {present('licencia')} AS has_license FROM listings),
f AS (SELECT *, bool_or(has_license) OVER w AS any_license, count_if(NOT has_license) OVER w AS n FROM g WINDOW w AS (PARTITION BY plataforma, group_id))
SELECT row_id, group_id FROM f WHERE has_license OR NOT any_license OR n <> 1"""

ORACLE["unlicensed_survivors"] = f"""WITH {PGROUP},
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plataforma, group_id ORDER BY row_id) AS rn
                     FROM pgi WHERE licencia IS NULL) WHERE rn = 1)
SELECT row_id, plataforma, group_id || 'Na' AS group_id FROM u"""

ORACLE["first_seen"] = f"""WITH {LISTINGS}
SELECT plataforma, property_id, min(row_id) AS row_id FROM listings GROUP BY plataforma, property_id"""

ORACLE["first_per_group"] = f"""WITH {GROUPS}
SELECT plataforma, group_id, row_id, nombre FROM (SELECT *, row_number() OVER (PARTITION BY plataforma, group_id ORDER BY row_id) AS rn FROM g) WHERE rn = 1"""

TITLE_PAIRS = f"""{LISTINGS},
tt AS (SELECT *, {title_norm('nombre')} AS title_norm FROM listings WHERE lat IS NOT NULL AND lng IS NOT NULL),
tp AS (SELECT a.row_id AS src, b.row_id AS dst, a.title_norm AS ta, b.title_norm AS tb FROM tt a JOIN tt b
       ON a.plataforma = b.plataforma AND a.capacidad = b.capacidad AND a.habitaciones = b.habitaciones
       AND a.row_id < b.row_id AND abs(a.lat - b.lat) < 0.01
       WHERE {haversine('a.lat', 'a.lng', 'b.lat', 'b.lng', R_INDEX)} <= 0.2),
ts AS (SELECT src, dst, CASE WHEN greatest(length(ta), length(tb)) = 0 THEN 1.0
                             ELSE 1.0 - levenshtein(ta, tb) / greatest(length(ta), length(tb)) END AS similarity FROM tp),
te AS (SELECT * FROM ts WHERE similarity >= 0.7)"""

ORACLE["title_edges_levenshtein"] = f"""WITH {TITLE_PAIRS}
SELECT src, dst, round(similarity, 6) AS similarity FROM te"""

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "
LOOSE = f"""{LISTINGS},
lt AS (SELECT *, regexp_replace({title_norm('nombre')}, '^(casa|villa|finca|hotel) ', '') AS t, CAST(floor(lat / 0.08) AS BIGINT) AS bin FROM listings WHERE lat IS NOT NULL AND lng IS NOT NULL),
lc AS (SELECT row_id, list_transform(range({len(LETTERS)}), lambda k: length(t) - length(replace(t, substr('{LETTERS}', CAST(k + 1 AS BIGINT), 1), ''))) AS cs,
              length(translate(t, '{LETTERS}', '')) AS other FROM lt),
lp AS (SELECT a.row_id AS src, b.row_id AS dst, a.plataforma, a.t AS ta, b.t AS tb, a.capacidad = b.capacidad AND a.habitaciones = b.habitaciones AS alike
       FROM lt a JOIN (SELECT *, unnest([-1, 0, 1]) AS off FROM lt) b ON a.plataforma = b.plataforma AND a.bin = b.bin + b.off AND a.row_id < b.row_id
       WHERE {haversine('a.lat', 'a.lng', 'b.lat', 'b.lng', R_INDEX)} <= 8.0)"""

ORACLE["title_edges_loose"] = f"""WITH {LOOSE}
SELECT src, dst, round(1.0 - levenshtein(ta, tb) / greatest(length(ta), length(tb)), 6) AS similarity FROM lp
WHERE alike AND 1.0 - levenshtein(ta, tb) / greatest(length(ta), length(tb)) >= 0.8"""

ORACLE["title_candidate_report"] = f"""WITH {LOOSE},
lb AS (SELECT lp.plataforma, 2.0 * least(length(ta), length(tb)) / (length(ta) + length(tb)) AS by_length,
  CAST(2.0 AS DOUBLE) * (list_sum(list_transform(list_zip(a.cs, b.cs), lambda p: least(p[1], p[2]))) + least(a.other, b.other)) / (length(ta) + length(tb)) AS by_letters
  FROM lp JOIN lc a ON a.row_id = src JOIN lc b ON b.row_id = dst)
SELECT plataforma, count(*) AS candidates, count_if(by_length >= 0.7) AS by_length, count_if(by_letters >= 0.7) AS by_letters,
       round(count_if(by_letters >= 0.7) / count(*), 6) AS share FROM lb GROUP BY plataforma"""

ORACLE["connected_components"] = f"""WITH RECURSIVE {TITLE_PAIRS},
ue AS (SELECT src AS u, dst AS v FROM te UNION ALL SELECT dst AS u, src AS v FROM te),
reach(node, lbl) AS (SELECT row_id, row_id FROM tt UNION SELECT ue.v, r.lbl FROM reach r JOIN ue ON ue.u = r.node)
SELECT node AS row_id, min(lbl) AS component FROM reach GROUP BY node"""

ORACLE["add_row_id"] = f"""WITH {LISTINGS}
SELECT row_id, plataforma, coalesce(licencia, '') AS lic,
       row_number() OVER (PARTITION BY plataforma ORDER BY coalesce(licencia, ''), row_id) - 1 AS pos FROM listings"""

ORACLE["union_listings"] = f"""WITH {LISTINGS}
SELECT row_id, nombre, lat, NULL::INTEGER AS capacidad FROM listings WHERE plataforma = 'airbnb'
UNION ALL
SELECT row_id, nombre, NULL::DOUBLE AS lat, capacidad FROM listings WHERE plataforma = 'booking'
UNION ALL
SELECT row_id, nombre, lat, NULL::INTEGER AS capacidad FROM listings WHERE plataforma = 'holidu'
UNION ALL
SELECT row_id, nombre, NULL::DOUBLE AS lat, capacidad FROM listings WHERE plataforma = 'vrbo'"""

ORACLE["distinct_listings"] = f"""WITH {LISTINGS}
SELECT DISTINCT property_id, plataforma, tipo, habitaciones FROM listings"""


def first_by_property(cond: str) -> str:
    return (f"fp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY row_id) AS rn "
            f"FROM listings WHERE {cond}) WHERE rn = 1)")


ORACLE["flatten_booking"] = f"""WITH {LISTINGS}, {first_by_property("plataforma = 'booking' AND lat IS NOT NULL")}
SELECT 'bk' || CAST(property_id AS VARCHAR) AS name, lat, lng,
       CASE WHEN anfitrion IS NULL THEN NULL ELSE nombre END AS DisplayName FROM fp"""

ORACLE["flatten_holidu"] = f"""WITH {LISTINGS}, {first_by_property("plataforma = 'holidu' AND lat IS NOT NULL")}
SELECT 'h' || CAST(property_id AS VARCHAR) AS id, lat, lng, nombre, habitaciones, capacidad, tipo FROM fp"""

ORACLE["flatten_vrbo"] = f"""WITH {LISTINGS}, fp AS (SELECT * FROM listings WHERE plataforma = 'vrbo' AND lat IS NOT NULL)
SELECT 'v' || CAST(row_id AS VARCHAR) AS id, lat, lng,
       'https://www.vrbo.com/es-es/p' || CAST(property_id AS VARCHAR) || '?dateless=true' AS url,
       nombre, tipo, capacidad, habitaciones FROM fp"""

RX_REG = r"(?i)Registration Details\s*(?:</b>)?(?:<br\s*/?>)*\s*([A-Za-z0-9./: _,\\-]+)"


def _grp(t: str, rx: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '{rx}') THEN {strip(f'regexp_extract({t}, {chr(39)}{rx}{chr(39)}, 1)')} END"


ORACLE["flatten_airbnb_detail"] = f"""WITH {LISTINGS},
a AS (SELECT *, '<p>Contacto</p><b>Registration Details</b><br/>' || coalesce(licencia, '') AS h FROM listings WHERE plataforma = 'airbnb')
SELECT row_id AS payload_id, lat, lng, capacidad, habitaciones, 1 AS banos, nombre AS titulo,
       {_grp('h', RX_REG)} AS licencia,
       CASE WHEN anfitrion IS NULL THEN NULL WHEN starts_with(anfitrion, 'HOST') THEN {strip('anfitrion')} ELSE anfitrion END AS anfitrion
FROM a"""

RX_ADULTS = r'aria-label="(\d+)\s+adultos?(?:,\s*(\d+)\s+niños?)?'
_T = "page_text"
_H = "page_html"
PAGES = f"""pgs AS (SELECT row_id AS listing_id, plataforma,
  CASE plataforma
   WHEN 'booking' THEN 'Número de licencia: ' || coalesce(licencia, '') || chr(10) || 'Ofertas en Mallorca (' || coalesce(tipo, '') || ')'
        || chr(10) || 'Dormitorio ' || coalesce(CAST(habitaciones AS VARCHAR), '') || chr(10) || 'Cama doble'
   WHEN 'holidu' THEN CASE WHEN anfitrion = 'Vrbo' THEN 'Gestionado por Holidu'
        ELSE 'Nuestro socio verificado ' || coalesce(anfitrion, '') || ' gestionará tu reserva' END
        || chr(10) || 'Número de licencia: ' || coalesce(licencia, '')
   WHEN 'vrbo' THEN 'Propietario/a: ' || coalesce(anfitrion, '') || chr(10) || 'Número de registro de la propiedad ' || coalesce(licencia, '')
   ELSE '' END AS page_text FROM listings),
pgh AS (SELECT p.*, l.capacidad, l.habitaciones, l.anfitrion, l.licencia, CASE p.plataforma
   WHEN 'booking' THEN CASE WHEN l.capacidad IS NOT NULL THEN '<div aria-label="' || CAST(l.capacidad AS VARCHAR) || ' adultos'
        || CASE WHEN l.habitaciones > 2 THEN ', ' || CAST(l.habitaciones - 2 AS VARCHAR) || ' niños' ELSE '' END || '"></div>' ELSE '' END
        || CASE WHEN l.anfitrion IS NOT NULL THEN '{{"__typename":"HotelierInfo","name":"' || l.anfitrion || '"}}' ELSE '' END
   WHEN 'airbnb' THEN '<p>Contacto</p><b>Registration Details</b><br/>' || coalesce(l.licencia, '') || chr(10) || '{{"title":"Host: ' || coalesce(l.anfitrion, '') || '"}}'
   ELSE '<html>' || p.page_text || '</html>' END AS page_html
  FROM pgs p JOIN listings l ON p.listing_id = l.row_id),
ext AS (SELECT listing_id, plataforma, page_text, page_html,
  len(regexp_extract_all(page_html, '{RX_ADULTS}', 0)) = 1 AS one,
  list_transform(regexp_extract_all(page_text, '(?i)dormitorio\\s*(\\d)', 1), lambda x: CAST(x AS INTEGER)) AS dorms,
  coalesce(CASE WHEN regexp_matches(page_html, '"HotelierInfo","name"\\s*:\\s*"([^"]+)"') THEN regexp_extract(page_html, '"HotelierInfo","name"\\s*:\\s*"([^"]+)"', 1) END,
           {_grp(_H, r'(?mi)^\s*(.+?)\s*$\r?\n\s*Marca/cadena de hotel\b')},
           {_grp(_H, r'(?mi)^\s*Datos de la empresa\s*\n\s*([^\n\r]+)')}) AS bhost
  FROM pgh)"""

ORACLE["extract_page_attributes"] = f"""WITH {LISTINGS}, {PAGES}
SELECT listing_id,
  CASE WHEN plataforma = 'booking' AND one AND len(dorms) > 0 THEN list_max(dorms) END AS habitaciones,
  CASE WHEN plataforma = 'booking' AND one THEN CAST(regexp_extract(page_html, '{RX_ADULTS}', 1) AS INTEGER) END AS capacidad,
  CASE WHEN plataforma = 'booking' AND one THEN coalesce(CAST(nullif(regexp_extract(page_html, '{RX_ADULTS}', 2), '') AS INTEGER), 0) END AS ninos,
  CASE WHEN plataforma IN ('booking', 'holidu') THEN {_grp(_T, r'(?i)Número de licencia:\s*([^\n<]+)')}
       WHEN plataforma = 'vrbo' THEN coalesce({_grp(_T, r'(?i)Número de registro de la propiedad\s*([^\n<]+)')},
                                              {_grp(_T, r'(?i)Licencia turística:\s*([^\n<]+)')})
       WHEN plataforma = 'airbnb' THEN {_grp(_H, RX_REG)} END AS licencia,
  CASE WHEN plataforma = 'booking' AND regexp_matches(page_text, '(?i)Ofertas en .*?\\(([^)]+)\\)')
       THEN regexp_extract(page_text, '(?i)Ofertas en .*?\\(([^)]+)\\)', 1) END AS tipo,
  CASE WHEN plataforma = 'booking' THEN CASE WHEN length(bhost) <= 1000 THEN bhost END
       WHEN plataforma = 'holidu' THEN CASE WHEN regexp_matches(page_text, 'Gestionado por Holidu') THEN 'Holidu'
            ELSE {_grp(_T, r'(?i)Nuestro socio verificado\s+(.+?)\s+gestionará tu reserva')} END
       WHEN plataforma = 'vrbo' THEN {_grp(_T, r'(?i)Propietario/a:\s*([^\n<]+)')}
       WHEN plataforma = 'airbnb' THEN {_grp(_H, r'"title"\s*:\s*"(?i:[^"]*?\b(?:Anfitri[oó]n|Host)\b\s*:\s*)([^"]+)"')} END AS anfitrion
FROM ext"""

ORACLE["extract_listing_cards"] = f"""WITH {LISTINGS},
a AS (SELECT *, CAST(floor(row_id / 72) AS BIGINT) AS page_id FROM listings WHERE plataforma = 'airbnb'),
c AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY row_id) AS card_pos FROM a)
SELECT page_id, card_pos, nombre AS Nombre, '/rooms/' || CAST(property_id AS VARCHAR) || '?adults=2' AS url,
       CAST(capacidad * 35 AS VARCHAR) || ' € noche' AS Precio, '1–7 jul' AS Fechas
FROM c WHERE capacidad IS NOT NULL"""

BOXES_SQL = """bx(isla, box_lat0, box_lng0, box_lat1, box_lng1) AS (VALUES
 ('mallorca', 39.10129556224702, 2.3739429649583883, 40.17457797140084, 3.4572007960993005),
 ('menorca', 39.73202837261271, 3.8166048322976565, 40.183968810121, 4.306760466171312),
 ('ibiza', 38.76877967614272, 1.19828131814009, 39.164966472991914, 1.6218922749454237),
 ('formentera', 38.579720345013094, 1.3865663541037065, 38.77151823526658, 1.5908027388515222))"""


def tiles_ctes(rule: str, min_deg, D: int, which: str = "") -> str:
    side = 1 << D
    small = f"depth >= {D}"
    if min_deg is not None:
        small += (f" OR (box_lat1 - box_lat0) / pow(2.0, depth) <= {min_deg}"
                  f" OR (box_lng1 - box_lng0) / pow(2.0, depth) <= {min_deg}")
    return f"""{BOXES_SQL},
tp AS (SELECT l.*, {ISLANDS} AS isla FROM (SELECT * FROM listings {which}) l WHERE lat IS NOT NULL AND lng IS NOT NULL),
tc AS (SELECT t.row_id, t.isla, least(CAST(floor((lng - box_lng0) / (box_lng1 - box_lng0) * {side}) AS BIGINT), {side - 1}) AS ix,
              least(CAST(floor((lat - box_lat0) / (box_lat1 - box_lat0) * {side}) AS BIGINT), {side - 1}) AS iy
       FROM tp t JOIN bx USING (isla)),
cells AS (SELECT isla, ix, iy, count(*) AS n FROM tc GROUP BY ALL),
ex AS (SELECT isla, ix, iy, n, d.depth, ix >> ({D} - d.depth) AS tx, iy >> ({D} - d.depth) AS ty
       FROM cells, (SELECT range AS depth FROM range(0, {D + 1})) d),
tn AS (SELECT isla, depth, tx, ty, sum(n) AS n FROM ex GROUP BY ALL),
st AS (SELECT tn.*, bx.box_lat0, bx.box_lng0, bx.box_lat1, bx.box_lng1,
              CASE WHEN n = 0 THEN 'empty' WHEN {rule} THEN 'leaf' WHEN {small} THEN 'ignored' ELSE 'split' END AS status
       FROM tn JOIN bx USING (isla)),
stp AS (SELECT ex.isla, ex.ix, ex.iy, min(CASE WHEN st.status <> 'split' THEN ex.depth END) AS stop_depth
        FROM ex JOIN st USING (isla, depth, tx, ty) GROUP BY ALL),
vis AS (SELECT st.* FROM st JOIN (SELECT DISTINCT ex.isla, ex.depth, ex.tx, ex.ty FROM ex JOIN stp USING (isla, ix, iy)
        WHERE ex.depth <= stp.stop_depth) v USING (isla, depth, tx, ty)),
kids AS (SELECT v.isla, v.depth + 1 AS depth, v.tx * 2 + k.dx AS tx, v.ty * 2 + k.dy AS ty
         FROM vis v, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) k(dx, dy) WHERE v.status = 'split'),
emp AS (SELECT k.isla, k.depth, k.tx, k.ty, 0::BIGINT AS n, bx.box_lat0, bx.box_lng0, bx.box_lat1, bx.box_lng1, 'empty' AS status
        FROM kids k JOIN bx USING (isla) WHERE NOT EXISTS (SELECT 1 FROM tn WHERE tn.isla = k.isla AND tn.depth = k.depth
        AND tn.tx = k.tx AND tn.ty = k.ty)),
alltiles AS (SELECT * FROM vis UNION ALL SELECT * FROM emp),
tiles AS (SELECT isla || '/' || CAST(depth AS VARCHAR) || '/' || CAST(tx AS VARCHAR) || '/' || CAST(ty AS VARCHAR) AS tile,
          isla, depth, tx, ty, box_lat0 + ty * ((box_lat1 - box_lat0) / pow(2.0, depth)) AS lat_min,
          box_lng0 + tx * ((box_lng1 - box_lng0) / pow(2.0, depth)) AS lng_min,
          box_lat0 + (ty + 1) * ((box_lat1 - box_lat0) / pow(2.0, depth)) AS lat_max,
          box_lng0 + (tx + 1) * ((box_lng1 - box_lng0) / pow(2.0, depth)) AS lng_max, n, status FROM alltiles)"""


ORACLE["adaptive_tiles"] = f"""WITH {LISTINGS}, {tiles_ctes("n < 100 AND n <> 30", 0.002, 10)}
SELECT * FROM tiles"""

ORACLE["assign_tile"] = f"""WITH {LISTINGS}, {tiles_ctes("n <= 30", 0.002, 10)}
SELECT tc.row_id, tc.isla || '/' || CAST(stp.stop_depth AS VARCHAR) || '/' || CAST(tc.ix >> (10 - stp.stop_depth) AS VARCHAR)
       || '/' || CAST(tc.iy >> (10 - stp.stop_depth) AS VARCHAR) AS tile, st.status
FROM tc JOIN stp USING (isla, ix, iy)
JOIN st ON st.isla = tc.isla AND st.depth = stp.stop_depth AND st.tx = tc.ix >> (10 - stp.stop_depth) AND st.ty = tc.iy >> (10 - stp.stop_depth)"""

ORACLE["assign_tile_divided"] = f"""WITH {LISTINGS}, {tiles_ctes("n <= 27", None, 24, "WHERE plataforma = 'airbnb'")},
al AS (SELECT l.*, {ISLANDS} AS isla FROM listings l WHERE lat IS NOT NULL AND lng IS NOT NULL)
SELECT al.row_id, tiles.tile, tiles.status FROM al JOIN bx USING (isla) JOIN tiles ON tiles.isla = al.isla AND tiles.status <> 'split'
  AND CAST(floor((lat - box_lat0) / (box_lat1 - box_lat0) * pow(2.0, depth)) AS BIGINT) = ty
  AND CAST(floor((lng - box_lng0) / (box_lng1 - box_lng0) * pow(2.0, depth)) AS BIGINT) = tx"""

ORACLE["page_plan"] = f"""WITH {LISTINGS}, {tiles_ctes("n <= 270", None, 24)}
SELECT tile, n, p.page, p.page * 18 AS item_offset
FROM tiles, LATERAL (SELECT range::INTEGER AS page FROM range(0, CAST(floor(n / 18) AS BIGINT) + 1)) p
WHERE status = 'leaf' AND n >= 1"""

ORACLE["encode_categories"] = f"""WITH {LISTINGS},
d AS (SELECT row_id, coalesce(plataforma, 'platform_desconocido') AS plataforma, coalesce(tipo, 'tipo_desconocido') AS tipo,
             coalesce(anfitrion, 'host_desconocido') AS anfitrion FROM listings)
SELECT row_id, dense_rank() OVER (ORDER BY plataforma) - 1 AS plataforma_id, dense_rank() OVER (ORDER BY tipo) - 1 AS tipo_id,
       dense_rank() OVER (ORDER BY anfitrion) - 1 AS anfitrion_id FROM d"""


def _mm(c, o):
    return (f"round(CASE WHEN {c} IS NULL THEN NULL WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 "
            f"ELSE (CAST({c} AS DOUBLE) - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 9) AS {o}")


ORACLE["scale_minmax"] = f"""WITH {LISTINGS}
SELECT row_id, {_mm('capacidad', 'cap_scaled')}, {_mm('habitaciones', 'hab_scaled')}, {_mm('lat', 'lat_scaled')},
       {_mm('lng', 'lon_scaled')} FROM listings"""

ORACLE["map_unknown_category"] = f"""WITH {LISTINGS},
d AS (SELECT row_id, plataforma, coalesce(tipo, 'tipo_desconocido') AS tipo FROM listings),
k AS (SELECT DISTINCT tipo FROM d WHERE plataforma = 'airbnb' AND tipo <> 'Hotel')
SELECT row_id, CASE WHEN tipo IN (SELECT tipo FROM k) THEN tipo ELSE 'tipo_desconocido' END AS tipo FROM d"""

ORACLE["model_similarity_edges"] = f"""WITH {LISTINGS},
e AS (SELECT l.row_id, l.lat, l.lng, coalesce(l.capacidad, -1) AS capacidad, coalesce(l.habitaciones, -1) AS habitaciones,
             CAST(m.embedding AS DOUBLE[]) AS v FROM listings l JOIN embeddings m
             ON m.vec_id = (l.property_id + CASE WHEN l.plataforma = 'vrbo' THEN 1 ELSE 0 END) % (SELECT count(*) FROM embeddings)
      WHERE l.lat IS NOT NULL AND l.lng IS NOT NULL),
p AS (SELECT a.row_id AS src, b.row_id AS dst,
             list_sum(list_transform(list_zip(a.v, b.v), lambda t: t[1] * t[2])) /
             (sqrt(list_sum(list_transform(a.v, lambda x: x * x))) * sqrt(list_sum(list_transform(b.v, lambda x: x * x)))) AS similarity
      FROM e a JOIN (SELECT *, unnest([-1, 0, 1]) AS off FROM e) b ON a.capacidad = b.capacidad AND a.habitaciones = b.habitaciones AND a.row_id < b.row_id
       AND CAST(floor(a.lat / 0.01) AS BIGINT) = CAST(floor(b.lat / 0.01) AS BIGINT) + b.off
      WHERE {haversine('a.lat', 'a.lng', 'b.lat', 'b.lng', R_INDEX)} <= 0.5)
SELECT src, dst, round(similarity, 6) AS similarity FROM p WHERE similarity >= 0.8"""


def _number(*parts: str) -> str:
    return "('0x' || substr(md5(" + " || '|' || ".join(parts) + "), 1, 15))::BIGINT"


def floyd_ctes(src: str, out: str, k: int) -> str:
    """CTEs: up to ``k`` of the pairs of each group of ``src`` (row_id, group_id)
    as (group_id, i, j), by ranking positions and drawing pair numbers one by one."""
    ctes = f"""{out}_pos AS (SELECT row_id, group_id, row_number() OVER (PARTITION BY group_id ORDER BY row_id) - 1 AS pos FROM {src} WHERE group_id IS NOT NULL),
{out}_0 AS (SELECT group_id, count(*) * (count(*) - 1) // 2 AS n, CAST([] AS BIGINT[]) AS drawn FROM {out}_pos GROUP BY group_id HAVING count(*) > 1)"""
    for t in range(k):
        last = f"(greatest(n - {k}, 0) + {t})"
        ctes += f""",
{out}_{t + 1} AS (SELECT group_id, n, CASE WHEN {t} >= n THEN drawn WHEN list_contains(drawn, one) THEN list_append(drawn, {last}) ELSE list_append(drawn, one) END AS drawn
  FROM (SELECT *, {_number("'42'", "group_id", f"'{t}'")} % ({last} + 1) AS one FROM {out}_{t}))"""
    return ctes + f""",
{out}_all AS (SELECT a.group_id, a.pos AS p, b.pos AS q, a.row_id AS i, b.row_id AS j FROM {out}_pos a JOIN {out}_pos b ON a.group_id = b.group_id AND a.pos < b.pos),
{out} AS (SELECT a.group_id, a.i, a.j FROM {out}_all a JOIN {out}_{k} d ON a.group_id = d.group_id WHERE list_contains(d.drawn, a.q * (a.q - 1) // 2 + a.p))"""


POSITIVES = f"""{SPLIT},
tr AS (SELECT * FROM split WHERE NOT coalesce(contains(group_id, 'ANCH'), false) AND group_id IS NOT NULL),
{floyd_ctes('tr', 'fl', 10)},
pos AS (SELECT i, j, 1 AS label FROM fl)"""

ORACLE["positive_pairs"] = f"WITH RECURSIVE {POSITIVES} SELECT * FROM pos"
ORACLE["sample_positives"] = f"""WITH {LISTINGS}, lg AS (SELECT row_id, tipo || '/' || plataforma AS group_id FROM listings),
{floyd_ctes('lg', 'fl', 3)}
SELECT group_id, i, j FROM fl"""


def _draw(turn: int) -> str:
    return f"('0x' || substr(md5('42|{turn}|' || CAST(id AS VARCHAR)), 1, 12))::BIGINT"


def hard_ctes(out: str, draws: str) -> str:
    """CTEs: the hard negatives drawn with ``draws`` numbers (all of them when
    there are no more pairs than that)."""
    return f"""{out}_n AS (SELECT CAST({draws} AS HUGEINT) AS draws),
{out}_cut AS (SELECT *, CAST((upto - n) * draws // total AS BIGINT) AS lo, CAST(upto * draws // total AS BIGINT) AS hi FROM ccell, {out}_n),
{out}_dr AS (SELECT DISTINCT c.capacidad, c.habitaciones, {_number("'42'", "CAST(t.range AS VARCHAR)")} % c.n AS r
  FROM (SELECT unnest(range(0, CAST(draws AS BIGINT))) AS range FROM {out}_n) t JOIN {out}_cut c ON t.range >= c.lo AND t.range < c.hi),
{out} AS (SELECT i, j FROM call WHERE (gi = gj) IS NOT TRUE AND ((SELECT draws FROM {out}_n) >= (SELECT max(total) FROM ccell)
  OR (capacidad, habitaciones, q * (q - 1) // 2 + p) IN (SELECT (capacidad, habitaciones, r) FROM {out}_dr)))"""


NEGATIVES = f"""{POSITIVES},
hc AS (SELECT tr.row_id, tr.group_id, capacidad, coalesce(habitaciones, -1) AS habitaciones,
              row_number() OVER (PARTITION BY capacidad, coalesce(habitaciones, -1) ORDER BY tr.row_id) - 1 AS p
       FROM tr WHERE capacidad IS NOT NULL),
ccell AS (SELECT *, sum(n) OVER (ORDER BY capacidad, habitaciones) AS upto, sum(n) OVER () AS total
          FROM (SELECT capacidad, habitaciones, CAST(count(*) * (count(*) - 1) // 2 AS HUGEINT) AS n FROM hc GROUP BY ALL HAVING count(*) > 1)),
call AS (SELECT a.capacidad, a.habitaciones, a.p, b.p AS q, a.row_id AS i, b.row_id AS j, a.group_id AS gi, b.group_id AS gj
         FROM hc a JOIN hc b ON a.capacidad = b.capacidad AND a.habitaciones = b.habitaciones AND a.p < b.p),
ro AS (SELECT row_id, group_id, lat, lng, row_number() OVER (ORDER BY row_id) - 1 AS p, count(*) OVER () AS total FROM tr),
dr AS (SELECT pi, pj + CASE WHEN pj >= pi THEN 1 ELSE 0 END AS pj FROM (
         SELECT {_draw(1)} % t.total AS pi, {_draw(2)} % (t.total - 1) AS pj
         FROM (SELECT range AS id FROM range(0, 70000)), (SELECT count(*) AS total FROM tr) t)),
geo AS (SELECT a.row_id AS i, b.row_id AS j FROM dr JOIN ro a ON a.p = dr.pi JOIN ro b ON b.p = dr.pj
        WHERE a.group_id <> b.group_id AND {haversine('a.lat', 'a.lng', 'b.lat', 'b.lng')} > 0.5),
{hard_ctes('hard', '12 * (SELECT count(*) FROM pos)')},
nn AS (SELECT *, least(3 * np, h + g) AS k FROM (SELECT (SELECT count(*) FROM pos) AS np, (SELECT count(*) FROM (SELECT DISTINCT i, j FROM geo)) AS g,
       (SELECT count(*) FROM call WHERE (gi = gj) IS NOT TRUE) AS h)),
kk AS (SELECT k, (2 * k * h + h + g) // (2 * (h + g)) AS of_hard FROM nn),
nr AS (SELECT i, j, side, row_number() OVER (PARTITION BY side ORDER BY md5('42|' || CAST(i AS VARCHAR) || '|' || CAST(j AS VARCHAR)), i, j) AS r
       FROM (SELECT i, j, 'hard' AS side FROM hard UNION SELECT i, j, 'geo' AS side FROM geo)),
tp AS (SELECT i, j, label FROM pos UNION ALL SELECT DISTINCT i, j, 0 FROM nr, kk WHERE r <= CASE side WHEN 'hard' THEN of_hard ELSE k - of_hard END),
vg AS (SELECT group_id, row_number() OVER (ORDER BY md5('42|' || group_id), group_id) <= ceil(0.2 * count(*) OVER ()) AS val
       FROM (SELECT DISTINCT tr.group_id FROM tp JOIN tr ON tr.row_id = tp.i))"""

ORACLE["hard_negative_pairs"] = f"WITH RECURSIVE {NEGATIVES}, {hard_ctes('hd', '32 * (SELECT count(*) FROM hc)')} SELECT i, j, 0 AS label FROM hd"
ORACLE["hard_negative_pairs_exhaustive"] = f"WITH RECURSIVE {NEGATIVES} SELECT i, j, 0 AS label FROM call WHERE (gi = gj) IS NOT TRUE"
ORACLE["geo_negative_pairs"] = f"WITH RECURSIVE {NEGATIVES} SELECT i, j, 0 AS label FROM geo"
ORACLE["training_pairs"] = f"WITH RECURSIVE {NEGATIVES} SELECT * FROM tp"
ORACLE["pair_counts"] = f"WITH RECURSIVE {NEGATIVES} SELECT count(*) AS pairs, CAST(sum(label) AS BIGINT) AS positives FROM tp"
ORACLE["group_split"] = f"""WITH RECURSIVE {NEGATIVES}
SELECT tp.i, tp.j, tp.label, CASE WHEN vg.val THEN 'validation' ELSE 'train' END AS side
FROM tp JOIN tr ON tr.row_id = tp.i JOIN vg USING (group_id)"""

ORACLE["conform_listings"] = f"""WITH {LISTINGS}
SELECT row_id, plataforma, CASE WHEN plataforma = 'airbnb' THEN NULL ELSE CAST(property_id AS VARCHAR) END AS listing_id,
       nombre, tipo, lat, lng, capacidad, habitaciones, licencia, anfitrion FROM listings"""


def fitted_ctes() -> str:
    """CTEs ``fz``: the listings with ids and scaled values fitted on the Airbnb
    and Booking rows without hotels; unseen and missing values take the token."""
    cats = {"plataforma": ("platform_desconocido", "plat_id"), "tipo": ("tipo_desconocido", "tipo_id"), "anfitrion": ("host_desconocido", "host_id")}
    scaled = {"capacidad": ("cap_scaled", -1), "habitaciones": ("hab_scaled", -1), "lat": ("lat_scaled", 0.0), "lng": ("lon_scaled", 0.0)}
    known = "kn AS (SELECT * FROM listings WHERE plataforma IN ('airbnb', 'booking') AND tipo <> 'Hotel' AND row_id % 3 <> 0)"
    tables = [f"""k_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS id FROM
  (SELECT {c} AS v FROM kn WHERE {c} IS NOT NULL UNION SELECT '{t}' AS v))""" for c, (t, _) in cats.items()]
    ids = ", ".join(f"coalesce(k_{c}.id, (SELECT id FROM k_{c} WHERE v = '{t}')) AS {out}" for c, (t, out) in cats.items())
    fill = {"habitaciones": "coalesce(habitaciones, -1)"}
    nums = ", ".join(f"(CAST(coalesce(l.{c}, {z}) AS DOUBLE) - (SELECT min({fill.get(c, c)}) FROM kn)) / (SELECT max({fill.get(c, c)}) - min({fill.get(c, c)}) FROM kn) AS {out}"
                     for c, (out, z) in scaled.items())
    joins = " ".join(f"LEFT JOIN k_{c} ON l.{c} = k_{c}.v" for c in cats)
    return ",\n".join([LISTINGS, known, *tables, f"fz AS (SELECT l.*, {ids}, {nums} FROM listings l {joins})"])


ORACLE["load_features"] = f"""WITH {fitted_ctes()}
SELECT row_id, plat_id, tipo_id, host_id, round(cap_scaled, 9) AS cap_scaled, round(hab_scaled, 9) AS hab_scaled,
       round(lat_scaled, 9) AS lat_scaled, round(lon_scaled, 9) AS lon_scaled FROM fz"""

_Z = "2.5 " + " ".join(f"+ ({d}) * abs(a.{c} - b.{c}) + ({p}) * (a.{c} * b.{c})" for c, d, p in (
    ("plat_id", -0.25, 0.05), ("tipo_id", -1.5, 0.1), ("cap_scaled", -2.0, 0.0), ("hab_scaled", -2.0, 0.0),
    ("lat_scaled", -600.0, 0.0), ("lon_scaled", -400.0, 0.0)))

SCORED = f"""{fitted_ctes()},
fm AS (SELECT * REPLACE (coalesce(capacidad, -1) AS capacidad, coalesce(habitaciones, -1) AS habitaciones) FROM fz),
sc AS (SELECT a.row_id AS i, b.row_id AS j, 1.0 / (1.0 + exp(-({_Z}))) AS similarity
       FROM fm a JOIN (SELECT *, unnest([-1, 0, 1]) AS off FROM fm) b ON a.capacidad = b.capacidad AND a.habitaciones = b.habitaciones AND a.row_id < b.row_id
        AND CAST(floor(a.lat / 0.01) AS BIGINT) = CAST(floor(b.lat / 0.01) AS BIGINT) + b.off
       WHERE {haversine('a.lat', 'a.lng', 'b.lat', 'b.lng', R_INDEX)} <= 0.5)"""

ORACLE["score_pairs"] = f"WITH {SCORED} SELECT i, j, round(similarity, 9) AS similarity FROM sc"


ORACLE["pair_metrics"] = f"""WITH {SCORED},
lb AS (SELECT a.plataforma, similarity > 0.75 AS yes, a.property_id = b.property_id AS same FROM sc JOIN listings a ON a.row_id = sc.i JOIN listings b ON b.row_id = sc.j),
ct AS (SELECT plataforma, count_if(yes AND same) AS tp, count_if(yes AND NOT same) AS fp, count_if(NOT yes AND same) AS fn FROM lb GROUP BY plataforma)
SELECT plataforma, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0.0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0.0), 9) AS recall,
       round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 9) AS f1 FROM ct"""


def seeded_ctes(edges: str, vertices: str, out: str) -> str:
    """CTEs ``out`` (row_id, dup_group_id): the scan itself, component by
    component, one vertex a step, then what its seeds hold together."""
    return f"""{out}_e AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b FROM {edges} WHERE src <> dst),
{out}_b AS (SELECT a AS u, b AS v FROM {out}_e UNION SELECT b AS u, a AS v FROM {out}_e),
{out}_r(node, lbl) AS (SELECT DISTINCT u, u FROM {out}_b UNION SELECT b.v, r.lbl FROM {out}_r r JOIN {out}_b b ON b.u = r.node),
{out}_c AS (SELECT lbl, list(node ORDER BY node) AS nodes FROM (SELECT node, min(lbl) AS lbl FROM {out}_r GROUP BY node) GROUP BY lbl),
{out}_up AS (SELECT a, list(DISTINCT b) AS larger FROM {out}_e GROUP BY a),
{out}_s(lbl, nodes, k, seeds, taken) AS (SELECT lbl, nodes, 1, CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) FROM {out}_c
  UNION ALL SELECT lbl, nodes, k + 1, CASE WHEN list_contains(taken, nodes[k]) THEN seeds ELSE list_append(seeds, nodes[k]) END,
    CASE WHEN list_contains(taken, nodes[k]) THEN taken ELSE list_concat(taken, coalesce(larger, [])) END
  FROM {out}_s LEFT JOIN {out}_up ON a = nodes[k] WHERE k <= len(nodes)),
{out}_se AS (SELECT unnest(seeds) AS seed FROM {out}_s WHERE k = len(nodes) + 1),
{out}_k AS (SELECT e.a AS u, e.b AS v FROM {out}_e e JOIN {out}_se ON e.a = seed UNION SELECT e.b, e.a FROM {out}_e e JOIN {out}_se ON e.a = seed),
{out}_g(node, lbl) AS (SELECT row_id, row_id FROM {vertices} UNION SELECT k.v, g.lbl FROM {out}_g g JOIN {out}_k k ON k.u = g.node),
{out} AS (SELECT node AS row_id, min(lbl) AS dup_group_id FROM {out}_g GROUP BY node)"""


ORACLE["cluster_seeded_levenshtein"] = f"""WITH RECURSIVE {TITLE_PAIRS},
{seeded_ctes('te', 'tt', 'cs')}
SELECT row_id, dup_group_id FROM cs"""

ORACLE["model_dedup"] = f"""WITH RECURSIVE {SCORED},
me AS (SELECT i AS src, j AS dst FROM sc WHERE similarity >= 0.8),
{seeded_ctes('me', 'fm', 'cs')}
SELECT row_id, dup_group_id, plataforma, nombre FROM (SELECT fm.*, dup_group_id, row_number() OVER (PARTITION BY dup_group_id ORDER BY fm.row_id) AS rn
  FROM fm JOIN cs USING (row_id)) WHERE rn = 1"""


COLS = "row_id, property_id, plataforma, anfitrion, licencia, lat, lng, capacidad, habitaciones, nombre, tipo"
OUT_COLS = f"{COLS}, group_id, _license_norm, licencia_letras, licencia_numeros"

WITHIN = f"""{LISTINGS},
wd AS (SELECT * REPLACE (CASE WHEN plataforma = 'holidu' AND licencia = 'No proporcionado' THEN '' ELSE licencia END AS licencia) FROM listings
       WHERE NOT (plataforma = 'holidu' AND coalesce(regexp_matches(anfitrion, 'Vrbo|Booking.com'), false))),
wl0 AS (SELECT * FROM wd WHERE {present('anfitrion')} AND {present('licencia')}),{licence_ctes('wl0', 'wl1')},
wl2 AS (SELECT *, {host_norm('anfitrion')} AS _host_norm FROM wl1),{grouping_ctes('wl2', 'wl', '_license_norm', '_host_norm', ['plataforma'], True)},
wlic AS (SELECT {COLS}, group_id FROM (SELECT *, row_number() OVER (PARTITION BY plataforma, group_id ORDER BY row_id) AS rn FROM wl) WHERE rn = 1),
{TITLE_PAIRS[len(LISTINGS) + 2:].replace('FROM listings', 'FROM wd')},
{seeded_ctes('te', 'tt', 'wc')},
wt0 AS (SELECT wd.*, CAST(dup_group_id AS VARCHAR) AS _license_norm, {host_norm('anfitrion')} AS _host_norm FROM wd JOIN wc USING (row_id) WHERE {present('anfitrion')}),
{grouping_ctes('wt0', 'wt', '_license_norm', '_host_norm', ['plataforma'], False)},
wt1 AS (SELECT *, {present('licencia')} AS has FROM wt),
wt2 AS (SELECT *, bool_or(has) OVER w AS any_has, count_if(NOT has) OVER w AS lone FROM wt1 WINDOW w AS (PARTITION BY plataforma, group_id)),
wunl AS (SELECT {COLS}, group_id || 'Na' AS group_id FROM (SELECT *, row_number() OVER (PARTITION BY plataforma, group_id ORDER BY row_id) AS rn
         FROM wt2 WHERE licencia IS NULL AND NOT (NOT has AND any_has AND lone = 1)) WHERE rn = 1),
wnoh AS (SELECT {COLS}, NULL AS group_id FROM wd WHERE NOT {present('anfitrion')})"""

FILTERED = f"""{WITHIN},
wall AS (SELECT * FROM wlic UNION ALL SELECT * FROM wunl UNION ALL SELECT * FROM wnoh),{licence_ctes('wall', 'wf')},
wp AS (SELECT {OUT_COLS} FROM wf
 WHERE NOT (coalesce(licencia_letras IN {EXCL_LETTERS}, false) OR coalesce(contains(upper(licencia_letras), 'EDIFICI'), false))
  AND NOT coalesce(tipo IN {EXCL_TYPES}, false) AND capacidad IS NOT NULL)"""

ORACLE["within_platform_dedup_levenshtein"] = f"WITH RECURSIVE {FILTERED} SELECT * FROM wp"
ORACLE["platform_catalogue"] = f"""WITH RECURSIVE {WITHIN}
SELECT row_id, plataforma, group_id, licencia, anfitrion, nombre FROM (SELECT * FROM wlic UNION ALL SELECT * FROM wunl UNION ALL SELECT * FROM wnoh)
WHERE plataforma = 'vrbo'"""
ORACLE["catalogue"] = f"""WITH RECURSIVE {WITHIN}
SELECT row_id, property_id, plataforma, group_id, nombre FROM wlic UNION SELECT row_id, property_id, plataforma, group_id, nombre FROM wunl
UNION SELECT row_id, property_id, plataforma, group_id, nombre FROM wnoh"""

ORACLE["cross_platform_dedup_levenshtein"] = f"""WITH RECURSIVE {FILTERED},
cin AS (SELECT {COLS} FROM wp),
cu1 AS (SELECT *, {present('licencia')} AS has FROM wp),
cu2 AS (SELECT *, bool_or(has) OVER w AS any_has, count_if(NOT has) OVER w AS lone FROM cu1 WINDOW w AS (PARTITION BY group_id)),
cunl AS (SELECT {OUT_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY row_id) AS rn FROM cu2
         WHERE licencia IS NULL AND (group_id IS NULL OR NOT (NOT has AND any_has AND lone = 1))) WHERE rn = 1),
{SPLIT[len(LISTINGS) + 2:].replace('FROM listings', 'FROM cin')},
surv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY row_id) AS rn FROM split) WHERE rn = 1),
{NOHOST.replace('FROM listings', 'FROM cin')},
cnoh AS (SELECT {OUT_COLS} FROM nh WHERE _license_norm NOT IN (SELECT _license_norm FROM surv WHERE _license_norm IS NOT NULL))
SELECT {OUT_COLS} FROM surv UNION ALL SELECT {OUT_COLS} FROM cunl UNION ALL SELECT {OUT_COLS} FROM cnoh"""
