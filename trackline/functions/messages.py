"""Fields of a transponder message given as hex text, as Column expressions."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SHORT, LONG = 14, 28  # hex characters
PARITY_BITS = 24

# fixed values of the protocol
GENERATOR = 0x1FFF409
ALPHABET = "#ABCDEFGHIJKLMNOPQRSTUVWXYZ##### ###############0123456789######"
PROTOCOLS = {
    0: "Short air-air ACAS",
    4: "Short altitude reply",
    5: "Short identify reply",
    11: "All-call reply",
    16: "Long air-air ACAS",
    17: "Mode-S Extended Squitter (ADS-B)",
    18: "Mode-S Extended Squitter (ADS-B)",
    19: "Military Extended Squitter",
    20: "Comm-B altitude reply",
    21: "Comm-B identify reply",
}
LONG_MESSAGE = "Comm-D Extended Length Message"  # formats above 24 in the first five bits
TYPES = {
    (1, 4): "Identification messages",
    (5, 8): "Surface position messages (including global and local CPR)",
    (9, 18): "Airborne position messages (including global and local CPR)",
    (19, 19): "Airborne velocity messages",
    (28, 28): "Aircraft status reports (emergency/priority, TCAS RA)",
    (29, 29): "Target state and status messages",
    (31, 31): "Operational status reports (airborne and surface)",
}


def number(raw: Column, first: int, count: int) -> Column:
    """``count`` hex characters from position ``first`` as a number."""
    return F.conv(F.substring(raw, first + 1, count), 16, 10).cast("bigint")


def bits(raw: Column, first: int, count: int) -> Column:
    """``count`` bits from bit ``first`` as a number."""
    start, stop = first // 4, (first + count + 3) // 4
    spare = stop * 4 - first - count
    return F.shiftright(number(raw, start, stop - start), spare).bitwiseAND(
        F.lit((1 << count) - 1)
    )


def downlink_format(raw: Column) -> Column:
    return bits(raw, 0, 5)


def type_code(raw: Column) -> Column:
    """Type of an extended squitter, null for other messages."""
    return F.when(downlink_format(raw).isin(17, 18), bits(raw, 32, 5))


def protocol_name(format_: Column) -> Column:
    name = F.when(format_ > 24, LONG_MESSAGE)
    for value, text in PROTOCOLS.items():
        name = name.when(format_ == value, text)
    return name


def type_name(code: Column) -> Column:
    name = F.when(F.lit(False), "")
    for (low, high), text in TYPES.items():
        name = name.when(code.between(low, high), text)
    return name


def parity(raw: Column) -> Column:
    """The last 24 bits of the message."""
    return number(F.substring(raw, -PARITY_BITS // 4, PARITY_BITS // 4), 0, PARITY_BITS // 4)


def checksum(raw: Column) -> Column:
    """CRC-24 of everything before the parity field.

    A CRC is linear: it is the exclusive or of one value per byte, which depends on the
    byte and its place only. So it is a few look-ups, without a loop over bits.
    """
    return F.when(F.length(raw) == SHORT, _crc(raw, SHORT)).when(
        F.length(raw) == LONG, _crc(raw, LONG)
    )


def _crc(raw: Column, characters: int) -> Column:
    data = (characters * 4 - PARITY_BITS) // 8
    parts = []
    for place in range(data):
        values = (_remainder(byte, data - 1 - place) for byte in range(256))
        table = F.expr(f"array({','.join(map(str, values))})")
        parts.append(F.get(table, number(raw, 2 * place, 2).cast("int")))
    return reduce(lambda a, b: a.bitwiseXOR(b), parts).cast("bigint")


@cache
def _remainder(byte: int, bytes_after: int) -> int:
    """Remainder of a byte followed by more data bytes and the parity field, all zero."""
    value = byte
    for _ in range(8 * bytes_after + PARITY_BITS):
        value <<= 1
        if value >> PARITY_BITS + 8:
            value ^= GENERATOR << 8
    for bit in range(7, -1, -1):
        if value >> PARITY_BITS + bit:
            value ^= GENERATOR << bit
    return value


def entity_id(raw: Column) -> Column:
    """Address of the sender: in clear, or laid over the parity of other replies."""
    overlaid = F.lpad(F.lower(F.hex(checksum(raw).bitwiseXOR(parity(raw)))), 6, "0")
    return F.when(
        downlink_format(raw).isin(11, 17, 18), F.lower(F.substring(raw, 3, 6))
    ).otherwise(overlaid)


def identity(raw: Column, characters: int = 8) -> Column:
    """The call sign in an identification message, six bits per character."""
    letters = [
        F.substring(F.lit(ALPHABET), (bits(raw, 40 + 6 * k, 6) + 1).cast("int"), F.lit(1))
        for k in range(characters)
    ]
    return F.when(type_code(raw).between(1, 4), F.concat(*letters))


# Where the bits of the older altitude code lie in the 12-bit field, the lowest bit is 0.
FIVE_HUNDREDS = (2, 0, 10, 8, 6, 5, 3, 1)  # D2 D4 A1 A2 A4 B1 B2 B4
HUNDREDS = (11, 9, 7)  # C1 C2 C4


def _from_gray(field: Column, places: tuple[int, ...]) -> Column:
    """The number whose reflected binary code has the bits at ``places``, the highest first."""
    top = len(places) - 1
    code = sum(
        F.shiftleft(F.shiftright(field, place).bitwiseAND(F.lit(1)), top - n)
        for n, place in enumerate(places)
    )
    for step in (1, 2, 4):
        code = code.bitwiseXOR(F.shiftright(code, step))
    return code


def coded_altitude(field: Column) -> Column:
    """Feet of a 12-bit altitude field in the older code, in steps of 100; null for codes without meaning."""
    five, one = _from_gray(field, FIVE_HUNDREDS), _from_gray(field, HUNDREDS)
    one = F.when(one == 7, 5).when(one.isin(0, 5, 6), None).otherwise(one)
    one = F.when(five % 2 == 1, 6 - one).otherwise(one)
    return (five * 500 + one * 100 - 1300).cast("double")
