"""Text extractors for headings, titles and listing pages (regex, JVM-side).

Java's ``\\s`` and ``\\d`` are ASCII like RE2's; ``regexp_extract`` returns ''
where Python's ``re`` returns None, hence ``nullif_blank`` throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col, nullif_blank, py_strip

# Patterns of the page extractors.
RX_GUESTS = r"(?i)huésped(?:es)?"
RX_ROOMS_ES = r"(?i)habitaci[oó]n(?:es)?"
RX_BATHS_EN = r"(?i)bath(?:s)?"
RX_ROOMS_EN = r"(?i)bedroom(?:s)?"
RX_ADULTS = r'aria-label="(\d+)\s+adultos?(?:,\s*(\d+)\s+niños?)?'
RX_BEDROOM_DIGIT = r"(?i)dormitorio\s*(\d)"
RX_LICENCE_ES = r"(?i)Número de licencia:\s*([^\n<]+)"
RX_VRBO_REGISTRY = r"(?i)Número de registro de la propiedad\s*([^\n<]+)"
RX_VRBO_LICENCE = r"(?i)Licencia turística:\s*([^\n<]+)"
RX_AIRBNB_REGISTRATION = r"(?i)Registration Details\s*(?:</b>)?(?:<br\s*/?>)*\s*([A-Za-z0-9./: _,\\-]+)"
RX_TYPE = r"(?i)Ofertas en .*?\(([^)]+)\)"
RX_BOOKING_HOTELIER = r'"HotelierInfo","name"\s*:\s*"([^"]+)"'
RX_BOOKING_CHAIN = r"(?mi)^\s*(.+?)\s*$\r?\n\s*Marca/cadena de hotel\b"
RX_BOOKING_COMPANY = r"(?mi)^\s*Datos de la empresa\s*\n\s*([^\n\r]+)"
RX_HOLIDU_SELF = r"Gestionado por Holidu"
RX_HOLIDU_PARTNER = r"(?i)Nuestro socio verificado\s+(.+?)\s+gestionará tu reserva"
RX_VRBO_OWNER = r"(?i)Propietario/a:\s*([^\n<]+)"
RX_AIRBNB_TITLE_HOST = r'"title"\s*:\s*"(?i:[^"]*?\b(?:Anfitri[oó]n|Host)\b\s*:\s*)([^"]+)"'
HOST_MAX_CHARS = 1000


def _parts(text: Column) -> Column:
    return F.transform(F.split(text, "·"), lambda p: py_strip(p))


def _last_number(parts: Column, word_rx: str) -> Column:
    """Digits of the last part that names ``word_rx`` and holds a number."""
    hits = F.filter(F.transform(parts, lambda p: F.when(p.rlike(word_rx), F.regexp_extract(p, r"(\d+)", 1))),
                    lambda x: x.isNotNull() & (x != ""))
    return F.try_element_at(hits, F.lit(-1)).cast("int")


def parse_vrbo_heading(text: "Column | str") -> Column:
    """'Villa · 8 huéspedes · 4 habitaciones · 2 baños' -> struct(tipo, capacidad,
    habitaciones); the last matching part wins; empty or null -> nulls."""
    t = col(text)
    parts = _parts(t)
    ok = t.isNotNull() & (t != "")
    return F.struct(F.when(ok, F.try_element_at(parts, F.lit(1))).alias("tipo"),
                    F.when(ok, _last_number(parts, RX_GUESTS)).alias("capacidad"),
                    F.when(ok, _last_number(parts, RX_ROOMS_ES)).alias("habitaciones"))


def parse_airbnb_title(text: "Column | str") -> Column:
    """'Villa · 4 bedrooms · 2 baths' -> struct(habitaciones, banos)."""
    t = col(text)
    parts = _parts(t)
    ok = t.isNotNull() & (t != "")
    return F.struct(F.when(ok, _last_number(parts, RX_ROOMS_EN)).alias("habitaciones"),
                    F.when(ok, _last_number(parts, RX_BATHS_EN)).alias("banos"))


def booking_capacity(html: "Column | str") -> Column:
    """struct(adultos, ninos) only when the page has exactly one occupancy
    label; children default to 0."""
    h = col(html)
    one = F.size(F.regexp_extract_all(h, F.lit(RX_ADULTS), 0)) == 1
    kids = nullif_blank(F.regexp_extract(h, RX_ADULTS, 2))
    return F.struct(F.when(one, F.regexp_extract(h, RX_ADULTS, 1).cast("int")).alias("adultos"),
                    F.when(one, F.coalesce(kids.cast("int"), F.lit(0))).alias("ninos"))


def booking_rooms(html: "Column | str", text: "Column | str") -> Column:
    """Largest single-digit bedroom count in the text, only when the page has
    exactly one occupancy label."""
    one = F.size(F.regexp_extract_all(col(html), F.lit(RX_ADULTS), 0)) == 1
    nums = F.transform(F.regexp_extract_all(col(text), F.lit(RX_BEDROOM_DIGIT), 1), lambda x: x.cast("int"))
    return F.when(one & (F.size(nums) > 0), F.array_max(nums))


def _first_group(c: Column, rx: str) -> Column:
    return F.when(c.rlike(rx), py_strip(F.regexp_extract(c, rx, 1)))


def extract_licence(platform: "Column | str", text: "Column | str") -> Column:
    p, t = col(platform), col(text)
    return (F.when(p.isin("booking", "holidu"), _first_group(t, RX_LICENCE_ES))
            .when(p == "vrbo", F.coalesce(_first_group(t, RX_VRBO_REGISTRY), _first_group(t, RX_VRBO_LICENCE)))
            .when(p == "airbnb", _first_group(t, RX_AIRBNB_REGISTRATION)))


def extract_type(text: "Column | str") -> Column:
    t = col(text)
    return F.when(t.rlike(RX_TYPE), F.regexp_extract(t, RX_TYPE, 1))


def extract_host(platform: "Column | str", text: "Column | str") -> Column:
    """Booking: hotelier JSON name, else the line above 'Marca/cadena de hotel',
    else the line after 'Datos de la empresa'; over 1000 chars -> null.
    Holidu: self-managed -> 'Holidu', else the verified partner.  VRBO: owner
    line.  Airbnb: first JSON ``title`` naming a host."""
    p, t = col(platform), col(text)
    booking = F.coalesce(F.when(t.rlike(RX_BOOKING_HOTELIER), F.regexp_extract(t, RX_BOOKING_HOTELIER, 1)),
                         _first_group(t, RX_BOOKING_CHAIN), _first_group(t, RX_BOOKING_COMPANY))
    booking = F.when(F.length(booking) <= HOST_MAX_CHARS, booking)
    holidu = F.when(t.rlike(RX_HOLIDU_SELF), F.lit("Holidu")).otherwise(_first_group(t, RX_HOLIDU_PARTNER))
    return (F.when(p == "booking", booking).when(p == "holidu", holidu)
            .when(p == "vrbo", _first_group(t, RX_VRBO_OWNER))
            .when(p == "airbnb", _first_group(t, RX_AIRBNB_TITLE_HOST)))
