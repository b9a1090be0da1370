"""Column functions over captured packets: bytes, Radiotap cells, management elements, neighbor reports.

Bytes are arrays of integers, so a cell at a known offset is an array access. Walks over fields whose places depend on what
came before are folds; everything stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quietband import config as C

# Fixed values: (size, alignment) of each Radiotap field by presence bit; a bit without an entry ends the walk.
_RADIOTAP = {
    0: (8, 8), 1: (1, 1), 2: (1, 1), 3: (4, 2), 4: (2, 2), 5: (1, 1), 6: (1, 1), 7: (2, 2),
    8: (2, 2), 9: (2, 2), 10: (1, 1), 11: (1, 1), 12: (1, 1), 13: (1, 1), 14: (2, 2),
    15: (2, 2), 16: (1, 1), 17: (1, 1), 18: (8, 4), 19: (3, 1), 20: (8, 4), 21: (12, 2),
    22: (12, 8), 23: (12, 2), 24: (12, 2), 25: (6, 2), 26: (1, 1), 27: (4, 2),
}
_FIELD_BITS = 29
_BLOCK_STEPS = 12
# Neighbor entry length -> offsets of (address, short SSID, parameters, MLD).
_NEIGHBOR_LAYOUT = {
    1: (None, None, None, None), 2: (None, None, 1, None), 5: (None, 1, None, None),
    6: (None, 1, 5, None), 7: (1, None, None, None), 8: (1, None, 7, None),
    9: (1, None, 7, None), 11: (1, 7, None, None), 12: (1, 7, 11, None),
    13: (1, 7, 11, None), 16: (1, 7, 11, 13),
}
_LONGEST_LAYOUT = 16


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often and in whatever loop it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated(start: Column, step: Callable[[Column], Column], more: Callable[[Column], Column], most: Column) -> Column:
    """`step` applied to a state, from `start`, as long as `more` holds; it must hold no more than `most` times.

    A fold has no early end, so steps are taken in blocks, and a block is passed over once nothing more is to do.
    """
    within = F.sequence(F.lit(1), F.lit(_BLOCK_STEPS))

    def once(state: Column, _: Column) -> Column:
        return F.when(more(state), step(state)).otherwise(state)

    def block(state: Column, _: Column) -> Column:
        return F.when(more(state), F.aggregate(within, state, once)).otherwise(state)

    return F.aggregate(F.sequence(F.lit(0), (most / _BLOCK_STEPS).cast("int")), start, block)


def table(values: list) -> Column:
    return F.expr(f"array({', '.join('CAST(NULL AS INT)' if v is None else str(v) for v in values)})")


def byte_values(data: Column) -> Column:
    """The bytes of a binary cell as integers."""
    return F.when(F.length(data) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(F.decode(data, "ISO-8859-1"), ""), F.ascii)
    )


def one_byte(data: Column, at: Column | int) -> Column:
    """One byte of a binary cell as an integer."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.hex(F.substring(data, at + 1, F.lit(1))), 16, 10).cast("int")


def little_endian(values: Column, at: Column | int, size: int) -> Column:
    """Unsigned integer of up to seven bytes; NULL where the bytes end before it does."""
    at = F.lit(at) if isinstance(at, int) else at
    total = F.get(values, at).cast("bigint")
    for k in range(1, size):
        total = total + F.shiftleft(F.get(values, at + k).cast("bigint"), 8 * k)
    return total


def little_endian_text(values: Column, at: Column | int, size: int) -> Column:
    """Unsigned integer of up to eight bytes as decimal text."""
    at = F.lit(at) if isinstance(at, int) else at
    digits = F.concat(*[F.lpad(F.hex(F.get(values, at + k)), 2, "0") for k in reversed(range(size))])
    return F.conv(digits, 16, 10)


def hex_text(data: Column, at: Column, size: Column | int) -> Column:
    """Lower-case hex of the bytes from an offset (from 0)."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.lower(F.hex(F.substring(data, at + 1, size)))


def flag_text(value: Column) -> Column:
    return F.when(value, "True").otherwise("False")


def cells(values: Column) -> Column:
    """A list of cells; NULL where there is none."""
    return F.when(F.size(values) > 0, values)


def unrepeated(values: Column) -> Column:
    """Identical adjacent occurrences count as one."""
    return bound(values, lambda v: F.filter(v, lambda x, i: (i == 0) | (x != F.get(v, i - 1))))


def radiotap_fields(values: Column, size: Column) -> Column:
    """(word, bit, at) of each Radiotap field of the first `size` bytes, in order, until the header ends or a field is unknown."""

    def words(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(4), size - 4, F.lit(4)), lambda at: little_endian(v, at, 4))

    def used(all_words: Column) -> Column:
        """Presence words with what follows them; an extension bit says that one more word follows."""
        last = F.get(F.filter(F.transform(all_words, lambda w, i: F.when(~has(w, 31), i)), lambda i: i.isNotNull()), F.lit(0))
        return F.slice(all_words, F.lit(1), F.coalesce(last + 1, F.size(all_words)))

    def named(some: Column) -> Column:
        """A word of a vendor's name space is the last one whose bits are fields."""
        vendor = F.get(F.filter(F.transform(some, lambda w, i: F.when(has(w, 30), i)), lambda i: i.isNotNull()), F.lit(0))
        return F.slice(some, F.lit(1), F.coalesce(vendor + 1, F.size(some)))

    def has(word: Column, bit: int | Column) -> Column:
        return F.shiftright(word, bit).bitwiseAND(F.lit(1)) == 1 if isinstance(bit, int) else F.getbit(word, bit) == 1

    def marked(some: Column) -> Column:
        bits = F.sequence(F.lit(0), F.lit(_FIELD_BITS - 1))
        return F.flatten(F.transform(
            named(some), lambda w, i: F.transform(F.filter(bits, lambda b: has(w, b)), lambda b: F.struct(i.alias("word"), b.alias("bit")))
        ))

    sizes = table([_RADIOTAP.get(b, (None, 1))[0] for b in range(_FIELD_BITS)])
    aligns = table([_RADIOTAP.get(b, (None, 1))[1] for b in range(_FIELD_BITS)])

    def walk(some: Column) -> Column:
        start = F.struct(
            (F.size(some) * 4 + 4).alias("next"), F.lit(False).alias("ended"),
            F.array().cast("array<struct<word:int,bit:int,at:int>>").alias("found"),
        )

        def step(state: Column, field: Column) -> Column:
            align = F.get(aligns, field["bit"])
            at = ((state["next"] + align - 1) / align).cast("int") * align
            after = at + F.get(sizes, field["bit"])
            ended = state["ended"] | F.coalesce(after > size, F.lit(True))
            return F.when(ended, F.struct(state["next"].alias("next"), F.lit(True).alias("ended"), state["found"].alias("found"))).otherwise(
                F.struct(
                    after.alias("next"), F.lit(False).alias("ended"),
                    F.array_append(state["found"], F.struct(field["word"].alias("word"), field["bit"].alias("bit"), at.alias("at"))).alias("found"),
                )
            )

        return F.aggregate(marked(some), start, step, lambda state: state["found"])

    return F.when(
        (size >= 8) & (size <= F.size(values)), bound(words(values), lambda all_words: bound(used(all_words), walk))
    ).otherwise(F.array().cast("array<struct<word:int,bit:int,at:int>>"))


def radiotap_cells(values: Column, fields: Column) -> dict[str, Column]:
    """Cells of the probed Radiotap fields, one text per occurrence; `rssi_dbm` is the signal of the first presence word only."""

    def of(bit: int, cell: Callable[[Column], Column], keep: Callable[[Column], Column] | None = None) -> Column:
        places = F.transform(F.filter(fields, lambda f: f["bit"] == bit), lambda f: f["at"])
        return cells(F.transform(F.filter(places, keep) if keep else places, lambda at: cell(at).cast("string")))

    def byte(at: Column) -> Column:
        return F.get(values, at)

    def signed(at: Column) -> Column:
        return byte(at) - F.when(byte(at) > 127, 256).otherwise(0)

    first = F.filter(fields, lambda f: (f["bit"] == 5) & (f["word"] == 0))
    return {
        "rssi_dbm": F.when(F.size(first) > 0, signed(F.get(first, F.lit(0))["at"])).cast("bigint"),
        "radiotap_tsft": of(0, lambda at: little_endian_text(values, at, 8)),
        "radiotap_flags_badfcs": of(1, lambda at: flag_text(byte(at).bitwiseAND(F.lit(0x40)) != 0)),
        "radiotap_datarate": of(2, lambda at: byte(at) / F.lit(2.0)),
        "radiotap_dbm_signal": of(5, signed),
        "radiotap_noise": of(6, signed),
        "radiotap_antenna": of(11, byte),
        "radiotap_db_signal": of(12, byte),
        "radiotap_db_noise": of(13, byte),
        "radiotap_mcs_index": of(19, lambda at: byte(at + 2)),
        "radiotap_vht_nss": of(21, lambda at: byte(at + 4).bitwiseAND(F.lit(0x0F)), lambda at: byte(at + 4) != 0),
        "radiotap_he_data1": of(23, lambda at: byte(at).bitwiseAND(F.lit(3))),
    }


def has_check_sequence(values: Column, fields: Column) -> Column:
    """Whether a flags field says that four bytes of check sequence follow the frame."""
    return F.exists(fields, lambda f: (f["bit"] == 1) & (F.get(values, f["at"]).bitwiseAND(F.lit(0x10)) != 0))


def element_places(values: Column, start: Column) -> Column:
    """(tag, size, at, whole) of the elements from `start` on: `at` is where the payload begins. An element that the packet cuts
    is the last one, and not whole."""
    end = F.size(values)
    first = F.struct(start.cast("int").alias("next"), F.array().cast("array<int>").alias("found"))

    def step(state: Column) -> Column:
        at = state["next"]
        return F.struct((at + 2 + F.get(values, at + 1)).alias("next"), F.array_append(state["found"], at).alias("found"))

    # An element takes two bytes at least.
    most = F.greatest(F.lit(0), end - start) / 2
    return F.transform(
        repeated(first, step, lambda state: state["next"] + 2 <= end, most)["found"],
        lambda at: F.struct(
            F.get(values, at).alias("tag"), F.get(values, at + 1).alias("size"), (at + 2).alias("at"),
            (at + 2 + F.get(values, at + 1) <= end).alias("whole"),
        ),
    )


def extension_elements(whole: Column) -> Column:
    """The extension elements that say which one they are."""
    return F.filter(whole, lambda e: (e["tag"] == C.TAG_EXTENSION) & (e["size"] > 0))


def element_cells(data: Column, values: Column, start: Column, places: Column, whole: Column, extensions: Column) -> dict[str, Column]:
    """Element ids and the cells taken from their payloads; `data` is the same packet as binary, `whole` are the places of
    whole elements."""
    ssid = F.get(F.filter(places, lambda e: e["tag"] == C.TAG_SSID), F.lit(0))
    # The first SSID element counts as text only where it opens the body.
    opens = (F.get(places, F.lit(0))["tag"] == C.TAG_SSID) & (F.get(places, F.lit(0))["at"] == start + 2)
    text = F.make_valid_utf8(F.substring(data, ssid["at"] + 1, ssid["size"]).cast("string"))
    load = F.filter(whole, lambda e: (e["tag"] == C.TAG_BSS_LOAD) & (e["size"] >= 5))
    color = F.filter(extensions, lambda e: (F.get(values, e["at"]) == 36) & (e["size"] >= 7))

    def each(chosen: Column, cell: Callable[[Column], Column]) -> Column:
        return cells(F.transform(chosen, lambda e: cell(e["at"]).cast("string")))

    return {
        "ssid_hex": F.when(ssid.isNotNull(), F.coalesce(F.nullif(hex_text(data, ssid["at"], ssid["size"]), F.lit("")), F.lit("<MISSING>"))),
        "ssid_text": F.when(F.coalesce(opens, F.lit(False)), F.translate(text, "\t\n\r", "   ")).otherwise(""),
        "tags": F.transform(F.filter(whole, lambda e: e["tag"] != C.TAG_EXTENSION), lambda e: e["tag"]),
        "exts": F.transform(extensions, lambda e: F.get(values, e["at"])),
        "he_bss_color": each(color, lambda at: F.get(values, at + 4).bitwiseAND(F.lit(0x3F))),
        "qbss_station_count": each(load, lambda at: little_endian(values, at, 2)),
        "qbss_utilization": each(load, lambda at: F.get(values, at + 2)),
        "qbss_admission": each(load, lambda at: little_endian(values, at + 3, 2)),
    }


def neighbor_reports(values: Column, whole: Column) -> Column:
    """(at, size, entries) of each neighbor information field of all report elements: `at` is its first byte, `size` the length
    of an entry and `entries` how many of them are there in full. A field that is cut ends its element."""
    kind = "array<struct<at:int,size:int,entries:int>>"

    def of(element: Column) -> Column:
        end = element["at"] + element["size"]
        first = F.struct(element["at"].alias("next"), F.array().cast(kind).alias("found"))

        def step(state: Column) -> Column:
            at = state["next"]
            count, size = F.shiftright(F.get(values, at), 4) + 1, F.get(values, at + 1)
            fit = F.when(size == 0, 0).otherwise(F.least(count, ((end - at - 4) / size).cast("int")))
            return F.struct(
                F.when(fit < count, end).otherwise(at + 4 + count * size).alias("next"),
                F.array_append(state["found"], F.struct(at.alias("at"), size.alias("size"), fit.alias("entries"))).alias("found"),
            )

        return repeated(first, step, lambda state: state["next"] + 4 <= end, element["size"] / 4)["found"]

    reports = F.filter(whole, lambda e: e["tag"] == C.TAG_RNR)
    return F.flatten(F.transform(reports, of))


def neighbor_entries(reports: Column) -> Column:
    """(at, size) of every neighbor entry."""
    return F.flatten(F.transform(reports, lambda r: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(15)), lambda k: k < r["entries"]),
        lambda k: F.struct((r["at"] + 4 + k * r["size"]).alias("at"), r["size"].alias("size")),
    )))


def neighbor_cells(data: Column, values: Column, reports: Column, entries: Column) -> dict[str, Column]:
    """Cells of neighbor reports; which an entry has depends on its length. Identical adjacent occurrences count as one."""
    layout = [_NEIGHBOR_LAYOUT.get(n, _NEIGHBOR_LAYOUT[1]) for n in range(_LONGEST_LAYOUT + 1)]

    def each(part: int, cell: Callable[[Column], Column]) -> Column:
        offsets = table([row[part] for row in layout])
        places = F.transform(entries, lambda e: e["at"] + F.get(offsets, F.least(e["size"], F.lit(_LONGEST_LAYOUT))))
        return cells(unrepeated(F.transform(F.filter(places, lambda at: at.isNotNull()), lambda at: cell(at).cast("string"))))

    def byte(at: Column) -> Column:
        return F.get(values, at)

    def head(offset: int) -> Column:
        return cells(unrepeated(F.transform(reports, lambda r: F.get(values, r["at"] + offset).cast("string"))))

    def hexed(value: Column, digits: int) -> Column:
        return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(value)), digits, "0"))

    return {
        "rnr_op_class": head(2),
        "rnr_channel": head(3),
        "rnr_bssid": each(0, lambda at: hex_text(data, at, 6)),
        "rnr_short_ssid": each(1, lambda at: hexed(little_endian(values, at, 4), 8)),
        "rnr_bss_params": each(2, lambda at: hexed(byte(at), 2)),
        "rnr_mld_id": each(3, byte),
        "rnr_mld_link_id": each(3, lambda at: byte(at + 1).bitwiseAND(F.lit(0x0F))),
        "rnr_disabled_link": each(3, lambda at: flag_text(byte(at + 2).bitwiseAND(F.lit(0x20)) != 0)),
    }
