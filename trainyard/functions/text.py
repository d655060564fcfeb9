"""Name handling: white space, station names, planned paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source data conventions for right results).
#
# Suffixes removed anywhere in a path station name, in this order:
PATH_SUFFIXES = [" (S)", " (U)", " (S+U)", "(S)", "(U)", "(S+U)"]
#
# Alias table for path station names.  Only keys that can still occur after
# the suffix removal and the "Berlin-" rewrite are listed (the others can
# never match); lookup is exact, then the result is stripped.
LIVE_PATH_ALIASES = {
    "Berlin Zoo": "Berlin Zoologischer Garten",
    "Zoo": "Berlin Zoologischer Garten",
    "Berlin Hauptbahnhof": "Berlin Hbf",
    "Berlin Hbf (S-Bahn)": "Berlin Hbf",
    "Berlin Yorckstr.(S1)": "Berlin Yorckstraße",
    "Berlin Yorckstr.(S2)": "Berlin Yorckstraße",
    "Berlin Südkreuz (Bus)": "Berlin Südkreuz",
    "Berlin Wittenau (Wilhelmsruher Damm)": "Berlin Wittenau",
    "Bernau(b Berlin)": "Bernau",
    "Borgsdorf, Hohen Neuendorf": "Borgsdorf",
    "Birkenwerder Hauptstraße": "Birkenwerder",
    "Buch, Berlin": "Berlin Buch",
    "Karow Bahnhof, Berlin": "Berlin Karow",
    "Pankow-Heinersdorf, Berlin": "Berlin Pankow-Heinersdorf",
    "Köpenick/Parrisiusstr., Berlin": "Berlin Köpenick",
    "Blankenburg, Berlin": "Berlin Blankenburg",
}
# Prefix rewrite applied before the alias lookup.
DASH_PREFIX, SPACE_PREFIX = "Berlin-", "Berlin "
# Station-file suffix, and the alias prefix used by the station map.
TIMETABLE_FILE_SUFFIX = "_timetable.xml"
ALIAS_PREFIX = "berlin "
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Remove leading and trailing Unicode white space (Spark's ``trim``
    removes blanks only)."""
    x = _c(x)
    return F.regexp_replace(F.regexp_replace(x, r"(?U)^\s+", ""),
                            r"(?U)\s+$", "")


def norm_name(x) -> Column:
    """Station-map key: strip, lower case, ``_`` -> blank, collapse runs of
    white space.  No second strip, so a leading ``_`` leaves a blank."""
    lowered = F.lower(strip(_c(x)))
    return F.regexp_replace(F.translate(lowered, "_", " "), r"(?U)\s+", " ")


def station_from_file(station_attr, file_name) -> Column:
    """Root ``station`` attribute, else the file name without the
    ``_timetable.xml`` suffix (any case) and with ``_`` read as blank."""
    base = F.regexp_replace(_c(file_name), r"(?i)_timetable\.xml$", "")
    return F.coalesce(F.nullif(_c(station_attr), F.lit("")),
                      F.translate(base, "_", " "))


def split_path(path, trimmed: bool = False) -> Column:
    """Split a ``A|B|C`` path, dropping segments that are blank after
    stripping; ``trimmed`` also strips the kept segments."""
    parts = F.split(_c(path), r"\|")
    kept = F.filter(parts, lambda s: strip(s) != "")
    return F.transform(kept, strip) if trimmed else kept


def _alias_map() -> Column:
    items = []
    for k, v in LIVE_PATH_ALIASES.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def normalize_station(x) -> Column:
    """Path-station normaliser: drop the suffixes anywhere, rewrite the
    ``Berlin-`` prefix, exact alias lookup, then strip (in that order, so a
    blank-padded name misses its alias and an alias result is not
    normalised again)."""
    name = _c(x)
    for suffix in PATH_SUFFIXES:
        name = F.replace(name, F.lit(suffix), F.lit(""))
    name = F.when(name.startswith(DASH_PREFIX),
                  F.concat(F.lit(SPACE_PREFIX),
                           F.substring(name, len(DASH_PREFIX) + 1, 1 << 30))
                  ).otherwise(name)
    looked_up = F.coalesce(F.try_element_at(_alias_map(), name), name)
    return strip(looked_up)
