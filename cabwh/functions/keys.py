"""Surrogate keys and text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def personnel_key(last_name="last_name", first_name="first_name", middle_name="middle_name",
                  birth_dt="birth_dt", null_safe: bool = False) -> Column:
    """md5 of the concatenated name parts and birth date.

    ``concat`` propagates NULL: a driver without a middle name gets a NULL key, as in the
    original warehouse. ``null_safe=True`` skips NULL parts instead (``concat_ws('')``).
    """
    parts = [_c(last_name), _c(first_name), _c(middle_name), _c(birth_dt).cast("string")]
    return F.md5(F.concat_ws("", *parts) if null_safe else F.concat(*parts))


def client_key(phone="phone_num", start_dt="start_dt") -> Column:
    """md5(phone || start_dt); NTZ timestamps print as 'yyyy-MM-dd HH:mm:ss' (zero fraction dropped)."""
    return F.md5(F.concat(_c(phone), _c(start_dt).cast("string")))


def transaction_key(ts_text="transaction_dt", card="card_num") -> Column:
    """md5 over the raw date text and the card number as they stand in the payment file."""
    return F.md5(F.concat(_c(ts_text).cast("string"), _c(card).cast("string")))


def format_card(card="card_num") -> Column:
    """'dddddddddddddddd' -> 'dddd dddd dddd dddd' (four groups of four)."""
    c = _c(card)
    blank = F.lit(" ")
    # concat (not concat_ws) so that a NULL card stays NULL, as with SQL ||
    return F.concat(F.substring(c, 1, 4), blank, F.substring(c, 5, 4), blank,
                    F.substring(c, 9, 4), blank, F.substring(c, 13, 4))


def trim_plate(plate="car_plate_num") -> Column:
    """Plates arrive blank-padded from the source."""
    return F.trim(_c(plate))
