"""IPv4 and flow identity expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_IPV4 = r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$"


def ipv4_number(address: Column) -> Column:
    """Dotted address as a number; NULL when it is not an IPv4 address."""
    octet = [F.split_part(address, F.lit("."), F.lit(i)).cast("bigint") for i in (1, 2, 3, 4)]
    number = octet[0] * 16_777_216 + octet[1] * 65_536 + octet[2] * 256 + octet[3]
    return F.when(address.rlike(_IPV4), number)


def prefix_length(cidr: Column) -> Column:
    """Mask length of a CIDR prefix; a bare address is a /32."""
    return F.coalesce(
        F.nullif(F.split_part(cidr, F.lit("/"), F.lit(2)), F.lit("")).try_cast("int"), F.lit(32)
    )


def network_of(number: Column, length: Column | int) -> Column:
    """The address with everything below the mask cleared."""
    host_bits = F.lit(32 - length) if isinstance(length, int) else F.lit(32) - length
    size = F.pow(F.lit(2.0), host_bits).cast("bigint")
    return number - F.pmod(number, size)


def _hex(number: Column, digits: int) -> Column:
    return F.lpad(F.hex(number.cast("bigint")), digits, "0")


def community_id(
    src_ip: Column, dst_ip: Column, src_port: Column, dst_port: Column, proto: Column, seed: int = 0
) -> Column:
    """Community ID version 1: the same value for both directions of a flow."""
    src, dst = ipv4_number(src_ip), ipv4_number(dst_ip)
    swap = (src > dst) | ((src == dst) & (src_port > dst_port))
    message = F.concat(
        _hex(F.lit(seed), 4),
        _hex(F.when(swap, dst).otherwise(src), 8),
        _hex(F.when(swap, src).otherwise(dst), 8),
        _hex(proto, 2),
        F.lit("00"),
        _hex(F.when(swap, dst_port).otherwise(src_port), 4),
        _hex(F.when(swap, src_port).otherwise(dst_port), 4),
    )
    return F.concat(F.lit("1:"), F.base64(F.unhex(F.sha1(F.unhex(message)))))
