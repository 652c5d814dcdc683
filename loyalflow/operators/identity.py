"""Identity resolution: list phone -> encrypted phone -> member id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.operators.joins import left_join_spread_nulls


def attach_encrypt_phone(base: DataFrame, encrypt_phone: DataFrame) -> DataFrame:
    """LEFT JOIN the phone -> encrypted phone lookup on the clean phone."""
    lookup = encrypt_phone.select(F.col("phone").alias("_enc_key"), "encrypt_phone")
    return base.join(lookup, base["phone"] == lookup["_enc_key"], "left").drop("_enc_key")


def phone_members(crm_member_phone: DataFrame) -> DataFrame:
    """Encrypted phone -> raw member id pairs (one phone may map to several members)."""
    return crm_member_phone.select(
        F.col("phone").alias("encrypt_phone"), F.col("member_detail_id").alias("phone_member_id"))


def identity_resolution(base: DataFrame, encrypt_phone: DataFrame, crm_member_phone: DataFrame) -> DataFrame:
    """Every distinct list phone with its encrypted phone and member ids (LEFT joins)."""
    phones = base.select("phone").distinct()
    with_enc = attach_encrypt_phone(phones, encrypt_phone)
    members = phone_members(crm_member_phone)
    # phones without an encrypted form keep a NULL key: spread them over the shuffle
    return (left_join_spread_nulls(with_enc, members, ["encrypt_phone"], ["phone"])
            .select("phone", "encrypt_phone", F.col("phone_member_id").alias("member_detail_id"))
            .distinct())
