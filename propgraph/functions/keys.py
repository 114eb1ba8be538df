"""Entity keys: arrays of signed bytes that hold a vertex or an edge identity.

Layouts
    legacy vertex key    UTF-8 bytes of the user id, then a 2-byte little-endian label index
    version 18 vertex key  64 bits: 12 shard, 12 label index, 40 inner id, big-endian
    edge key             bytes 0..7 start vertex, bytes 8..15 end vertex, the rest is opaque

All functions are expressions over an ``ARRAY<INT>`` column; a key that is too short gives null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key format.
PACKED_KEYS_SINCE = 18
VERTEX_KEY_BYTES = 8
SHARD_BITS = 12
LABEL_BITS = 12
INNER_ID_BITS = 40
LEGACY_LABEL_BYTES = 2


def _unsigned(value: Column) -> Column:
    return value.bitwiseAND(F.lit(255)).cast("bigint")


def _signed(value: Column) -> Column:
    """0..255 to -128..127."""
    return ((value + 128).bitwiseAND(F.lit(255)) - 128).cast("int")


def _byte(key: Column, index: int) -> Column:
    return _unsigned(F.get(key, F.lit(index)))


def key_text(key: Column) -> Column:
    """Canonical text of a key: its signed decimal bytes joined by blanks."""
    return F.array_join(key.cast("array<string>"), " ")


# --- version 18 -----------------------------------------------------------------------------------------------------


def pack_key(key: Column, offset: int = 0) -> Column:
    """The eight bytes from ``offset`` on as one BIGINT."""
    return reduce(
        Column.bitwiseOR, (F.shiftleft(_byte(key, offset + i), 56 - 8 * i) for i in range(VERTEX_KEY_BYTES))
    )


def unpack_key(packed: Column) -> Column:
    """A BIGINT as eight signed bytes."""
    return F.array(
        *(_signed(F.shiftrightunsigned(packed, 56 - 8 * i).bitwiseAND(F.lit(255))) for i in range(VERTEX_KEY_BYTES))
    )


def shard_id(key: Column, offset: int = 0) -> Column:
    """The first 12 bits: a byte and the high half of the next."""
    return F.shiftleft(_byte(key, offset), 4).bitwiseOR(F.shiftright(_byte(key, offset + 1), 4))


def label_index(key: Column, offset: int = 0) -> Column:
    """The next 12 bits: the low half of the second byte and the third byte."""
    return F.shiftleft(_byte(key, offset + 1).bitwiseAND(F.lit(15)), 8).bitwiseOR(_byte(key, offset + 2))


def inner_id(key: Column, offset: int = 0) -> Column:
    """The last 40 bits."""
    first = VERTEX_KEY_BYTES - INNER_ID_BITS // 8
    shifted = [F.shiftleft(_byte(key, offset + i), 8 * (VERTEX_KEY_BYTES - 1 - i)) for i in range(first, VERTEX_KEY_BYTES)]
    return reduce(Column.bitwiseOR, shifted)


def packed_vertex_key(shard: Column, label: Column, inner: Column) -> Column:
    """The 64 bits of a version 18 vertex key as one BIGINT."""
    return (
        F.shiftleft(shard.cast("bigint"), LABEL_BITS + INNER_ID_BITS)
        .bitwiseOR(F.shiftleft(label.cast("bigint"), INNER_ID_BITS))
        .bitwiseOR(inner.cast("bigint"))
    )


def vertex_key(shard: Column, label: Column, inner: Column) -> Column:
    """Build a version 18 vertex key."""
    return unpack_key(packed_vertex_key(shard, label, inner))


# --- legacy ---------------------------------------------------------------------------------------------------------


def legacy_label_index(key: Column) -> Column:
    size = F.size(key)
    low = _unsigned(F.get(key, size - 2))
    high = _unsigned(F.get(key, size - 1))
    return F.when(size >= LEGACY_LABEL_BYTES, high * 256 + low)


def legacy_uid(key: Column) -> Column:
    """User id of a legacy key; null if its bytes are not UTF-8."""
    size = F.size(key)
    uid_bytes = F.slice(key, F.lit(1), F.greatest(size - LEGACY_LABEL_BYTES, F.lit(0)))
    hex_text = F.array_join(F.transform(uid_bytes, lambda b: F.lpad(F.hex(_unsigned(b)), 2, "0")), "")
    return F.when(size >= LEGACY_LABEL_BYTES, F.try_validate_utf8(F.unhex(hex_text).cast("string")))


def legacy_vertex_key(uid: Column, label: Column) -> Column:
    """Build a legacy vertex key."""
    hex_text = F.hex(F.encode(uid, "utf-8"))
    uid_bytes = F.transform(
        F.filter(F.sequence(F.lit(0), F.length(hex_text), F.lit(2)), lambda i: i < F.length(hex_text)),
        lambda i: _signed(F.conv(F.substring(hex_text, i + 1, F.lit(2)), 16, 10).cast("int")),
    )
    index = label.cast("int")
    label_bytes = F.array(_signed(index.bitwiseAND(F.lit(255))), _signed(F.shiftright(index, 8).bitwiseAND(F.lit(255))))
    return F.concat(uid_bytes, label_bytes)


# --- edges ----------------------------------------------------------------------------------------------------------


def start_key(edge_key: Column) -> Column:
    return F.slice(edge_key, 1, VERTEX_KEY_BYTES)


def end_key(edge_key: Column) -> Column:
    return F.slice(edge_key, VERTEX_KEY_BYTES + 1, VERTEX_KEY_BYTES)
