"""Names: versions, products, paths, stamps, commit messages. Column functions, with driver forms where a config needs one."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1900-01-01"
VERSION = r"^[Vv]\d+(\.\d+)*$"


def version_token(version: Column) -> Column:
    """``V3.16`` -> ``v_3_16``; null where the text is no version."""
    return F.when(version.rlike(VERSION), F.concat(F.lit("v_"), F.translate(F.substring(version, 2, 1 << 20), ".", "_")))


def product_parts(product: Column) -> Column:
    """``Past/Daily`` -> [past, daily]; null unless there are exactly two parts that are not empty."""
    parts = F.filter(F.split(F.lower(product), "/"), lambda x: x != "")
    return F.when(F.size(parts) == 2, parts)


def stamp_of(day: Column) -> Column:
    """A date as year and day of year, the stamp in a file's name."""
    return F.date_format(day, "yyyyDDD")


def day_of_stamp(stamp: Column) -> Column:
    """The date of a ``yyyyDDD`` stamp; null for day 000, day 366 of a common year, or no stamp at all."""
    return F.when(stamp.rlike(r"^\d{7}$"), F.to_date(F.try_to_timestamp(stamp, F.lit("yyyyDDD"))))


def day_of_checked_stamp(name: Column) -> Column:
    """The date of a name that begins with a ``yyyyDDD`` stamp known to be a date. Arithmetic only: for every cell of a
    scan, parsing would cost several times the scan itself."""
    number = lambda start, n: F.substring(name, start, n).cast("int")
    return F.date_add(F.make_date(number(1, 4), F.lit(1), F.lit(1)), number(5, 3) - 1)


def days_since_epoch(day: Column) -> Column:
    return F.datediff(day, F.lit(EPOCH).cast("date")).cast("long")


def block_message(variable: Column, y0: Column, y1: Column, x0: Column, x1: Column) -> Column:
    """The commit message of a block; `block_of_message` reads it back."""
    return F.format_string("write block %s y[%d:%d] x[%d:%d]", variable, y0, y1, x0, x1)


BLOCK_MESSAGE = r"^write block (\S+) y\[(\d+):(\d+)\] x\[(\d+):(\d+)\]$"


def block_of_message(message: Column) -> dict[str, Column]:
    """variable, y0, y1, x0, x1 of a message; null where it is no block's."""
    is_block = message.rlike(BLOCK_MESSAGE)
    part = lambda i: F.when(is_block, F.regexp_extract(message, BLOCK_MESSAGE, i))
    return {"variable": part(1), "y0": part(2).cast("int"), "y1": part(3).cast("int"), "x0": part(4).cast("int"), "x1": part(5).cast("int")}


def batch_size(target: Column, chunk: Column) -> Column:
    """Whole chunks nearest to ``target`` rows, one at least; halves go to the even number."""
    return F.greatest(F.lit(1), F.bround(target / chunk)).cast("long") * chunk


def unit_note(conversion: Column, original: Column, canonical: Column) -> Column:
    """What was done to the units: a spelling changed, nothing, or a conversion that the key names."""
    return (
        F.when((conversion == "none") & original.eqNullSafe(canonical), F.lit("none"))
        .when(conversion == "none", F.concat(F.lit("none: "), original, F.lit(" and "), canonical, F.lit(" are one unit")))
        .otherwise(conversion)
    )


def size_text(n_bytes: Column) -> Column:
    """Bytes as GiB with two places."""
    return F.format_string("%.2f GiB", n_bytes / F.lit(float(1 << 30)))


# Driver forms, for a config's few strings.


def format_version(version: str) -> str:
    if not re.match(VERSION, version):
        raise ValueError(f"no version: {version!r}")
    return "v_" + version[1:].replace(".", "_")


def format_product(product: str) -> tuple[str, str]:
    parts = [x for x in product.lower().split("/") if x]
    if len(parts) != 2:
        raise ValueError(f"a product is <period>/<resolution>, not {product!r}")
    return parts[0], parts[1]


class _Fields(dict):
    def __missing__(self, key: str):
        raise ValueError(f"the template names {key!r}, which no field has; there are {sorted(self)}")


def format_text(template: str, fields: Mapping[str, Any]) -> str:
    return template.format_map(_Fields(fields))


def format_attributes(attributes: Mapping[str, Any], fields: Mapping[str, Any]) -> dict[str, Any]:
    """Every string through the template fields, those of one nested level too; other values pass as they are."""
    flat = [((k,), v) for k, v in attributes.items() if not isinstance(v, Mapping)]
    flat += [((k, inner), v) for k, own in attributes.items() if isinstance(own, Mapping) for inner, v in own.items()]
    shown = {path: format_text(v, fields) if isinstance(v, str) else v for path, v in flat}
    return {k: {path[1]: v for path, v in shown.items() if path[0] == k and path[1:]} if isinstance(own, Mapping) else shown[(k,)] for k, own in attributes.items()}
