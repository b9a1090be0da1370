"""Addresses, channels, elements and regulatory text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quietband import config as C
from quietband.functions.cells import bits_overlap, set_names


def canonical_mac(value: Column) -> Column:
    """Lower-case colon form when the value is twelve hex digits, unchanged otherwise."""
    bare = F.lower(F.regexp_replace(value, "[:-]", ""))
    return F.when(
        bare.rlike("^[0-9a-f]{12}$"), F.regexp_replace(bare, "(..)(?!$)", "$1:")
    ).otherwise(value)


def census_mac(value: Column) -> Column:
    """Census spelling: any twelve characters get colons, whatever they are."""
    low = F.lower(F.coalesce(value, F.lit("")))
    return F.when(
        F.length(low) == 12, F.regexp_replace(low, "(..)(?!$)", "$1:")
    ).otherwise(low)


def mac_octets(bssid: Column) -> Column:
    return F.transform(F.split(bssid, ":"), lambda o: F.conv(o, 16, 10).try_cast("int"))


def _first_octet(bssid: Column) -> Column:
    return F.conv(F.split_part(bssid, F.lit(":"), F.lit(1)), 16, 10).try_cast("int")


def is_locally_administered(bssid: Column) -> Column:
    return _first_octet(bssid).bitwiseAND(F.lit(2)) != 0


def is_multicast(bssid: Column) -> Column:
    return _first_octet(bssid).bitwiseAND(F.lit(1)) != 0


def oui(bssid: Column) -> Column:
    """Vendor prefix; meaningless, and therefore NULL, for a locally administered address."""
    return F.when(~is_locally_administered(bssid), F.lower(F.substring(bssid, 1, 8)))


def radio_family(bssid: Column) -> Column:
    """Octets 2-5 plus the high nibble of octet 6: a hypothesis about one physical radio."""
    low = F.lower(bssid)
    return F.concat(F.substring(low, 4, 11), F.lit(":"), F.substring(low, 16, 1), F.lit("_"))


def band_of_frequency(mhz: Column) -> Column:
    return F.when(mhz < 4900, "2.4GHz").when(mhz < 5925, "5GHz").otherwise("6GHz")


def band_rank(band: Column) -> Column:
    """Sort key 2.4 < 5 < 6 < anything else."""
    return F.when(band == "2.4GHz", 0).when(band == "5GHz", 1).when(band == "6GHz", 2).otherwise(9)


def opclass_band(op_class: Column) -> Column:
    """Band of a global operating class (fixed ranges)."""
    return (
        F.when(op_class.between(81, 84), "2.4GHz")
        .when(op_class.between(112, 130), "5GHz")
        .when(op_class.between(131, 137), "6GHz")
        .otherwise("unknown")
    )


def opclass_mhz(op_class: Column, channel: Column) -> Column:
    """Centre MHz of (operating class, channel); NULL for an unknown class.

    Class 82 is the single 2484 MHz channel and class 136 the single 5935 MHz one.
    """
    base = (
        F.when(op_class.between(81, 84), 2407)
        .when(op_class.between(112, 130), 5000)
        .when(op_class.between(131, 137), 5950)
    )
    return (
        F.when(op_class == 82, F.lit(2484))
        .when(op_class == 136, F.lit(5935))
        .otherwise(base + 5 * channel)
        .cast("bigint")
    )


def regulatory_state(flags_text: Column) -> Column:
    """Parenthesised kernel flags joined by ``+``; none left means permitted."""
    tokens = F.transform(F.regexp_extract_all(flags_text, F.lit(r"\(([^)]*)\)"), 1), F.trim)
    named = F.transform(
        F.filter(tokens, lambda t: (t != "") & ~t.contains("dBm")),
        lambda t: F.when(t == "no IR", "no-ir")
        .when(t == "radar detection", "radar")
        .otherwise(F.replace(t, F.lit(" "), F.lit("-"))),
    )
    return F.when(F.size(named) == 0, "permitted").otherwise(F.array_join(named, "+"))


def capability_flags(tags: Column | list[Column], exts: Column | list[Column]) -> dict[str, Column]:
    """The eleven advertised-capability flags from two sets of element ids: arrays, or lists of the words that hold their bits."""
    found = {}
    for source, table in ((tags, C.CAPABILITY_TAGS), (exts, C.CAPABILITY_EXTENSIONS)):
        for name, ids in table.items():
            found[name] = (
                bits_overlap(source, ids) if isinstance(source, list) else F.arrays_overlap(source, F.array(*[F.lit(i) for i in ids]))
            )
    return {name: F.coalesce(found[name], F.lit(False)) for name in C.CAPABILITY_COLUMNS}


def generations(exts: Column) -> Column:
    """Wi-Fi generations implied by extension ids (the multi-link id counts as EHT here)."""
    return set_names(
        [
            (F.arrays_overlap(exts, F.array(*[F.lit(i) for i in ids])), name)
            for name, ids in C.GENERATIONS
        ]
    )


def _name_of(table: dict[int, str], key: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, key.cast("int")), F.lit(C.UNMAPPED))


def element_name(tag: Column) -> Column:
    return _name_of(C.ELEMENT_NAMES, tag)


def extension_name(ext: Column) -> Column:
    return _name_of(C.EXTENSION_NAMES, ext)


def bss_parameter_names(cell: Column) -> Column:
    """Names of the bits set in a ``0x..`` BSS-parameters cell; NULL for other cells."""
    # All named bits are in the last byte, however many digits the cell has.
    value = F.conv(F.regexp_extract(cell, "([0-9A-Fa-f]{1,2})$", 1), 16, 10).try_cast("bigint")
    bits = [
        (value.bitwiseAND(F.lit(1 << n)) != 0, name)
        for n, name in enumerate(C.BSS_PARAMETER_BITS)
    ]
    return F.when(cell.rlike("^0x[0-9A-Fa-f]+$"), set_names(bits))


def view_disabled(cell: Column) -> Column:
    """Disabled-link predicate of the metric views; NULL stays NULL."""
    return cell.isin(*C.VIEW_DISABLED_VALUES)


def view_enabled_or_unknown(cell: Column) -> Column:
    return cell.isNull() | ~view_disabled(cell)


def census_disabled(cell: Column) -> Column:
    """Disabled-link predicate of the capture census; an absent cell is not disabled."""
    return F.coalesce(F.lower(F.trim(cell)).isin(*C.CENSUS_DISABLED_VALUES), F.lit(False))


def reception_ratio(count: Column, dwell_seconds: Column, interval_tu: Column) -> Column:
    """Received over expected beacons, 3 decimals, not clamped; NULL without an interval."""
    expected = dwell_seconds / (interval_tu * F.lit(C.TU_SECONDS))
    return F.when(interval_tu != 0, F.round(F.try_divide(count.cast("double"), expected), 3))
