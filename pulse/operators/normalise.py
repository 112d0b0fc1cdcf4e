"""Loader-side field normalisation for register records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulse.functions import text as txt


def normalise_register_fields(df: DataFrame, domain, trim: bool = True) -> DataFrame:
    """Apply the staging rules to register-shaped rows.

    * rows without a (non-blank) key are dropped;
    * legal_form / county / status: blank -> default, cut to 100 chars;
    * activity code / name / version: cut to 50 / 255 / 50 chars, NULL stays NULL;
    * ``trim`` trims after cutting (the full loader does, the increment does not).
    """
    key = txt.blank_to_null("entity_id")
    return (df.filter(key.isNotNull())
            .withColumn("entity_id", key)
            .withColumn("legal_form", txt.clip_default(txt.blank_to_null("legal_form"),
                                                       domain.default_legal_form, 100, trim))
            .withColumn("county", txt.clip_default(txt.blank_to_null("county"),
                                                   domain.default_county, 100, trim))
            .withColumn("status", txt.clip_default(txt.blank_to_null("status"),
                                                   domain.default_status, 100, trim))
            .withColumn("activity_code", txt.clip(txt.blank_to_null("activity_code"), 50, trim))
            .withColumn("activity_name", txt.clip(txt.blank_to_null("activity_name"), 255, trim))
            .withColumn("activity_version",
                        txt.clip(txt.blank_to_null("activity_version"), 50, trim)))
