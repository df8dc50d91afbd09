"""The four dictionaries and how they join."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, functions as F

from .. import constants as C
from ..operators.audit import repeated_lookup_keys
from ..operators.joins import fits_broadcast, lookup_join


@dataclass
class Dictionaries:
    mapping: DataFrame
    language: DataFrame
    store: DataFrame
    country: DataFrame
    _small: dict[str, bool] = field(default_factory=dict)
    _repeats: bool | None = None

    def small(self, name: str) -> bool:
        """Whether a dictionary may be broadcast: measured once, before its first join."""
        if name not in self._small:
            self._small[name] = fits_broadcast(getattr(self, name))
        return self._small[name]

    def multiplies_rows(self) -> bool:
        """Whether a repeated entry makes more than one Stage row of a raw row."""
        if self._repeats is None:
            status = self.mapping.where(
                (F.col("dict_code") == C.LEGAL_STATUS_DICT) & (F.col("is_valid") == 1)
            )
            checks = [
                repeated_lookup_keys(status, ["source_value"]).dropna(),
                repeated_lookup_keys(self.language, ["iso639_2"]).dropna(),
                repeated_lookup_keys(self.language, ["iso639_2_b"]).dropna(),
            ]
            self._repeats = any(not c.isEmpty() for c in checks)
        return self._repeats

    def store_of(self, table_id: str) -> Row:
        """The one store entry of a partition. None or several would lose or repeat all rows."""
        rows = self.store.where(F.col("table_id") == table_id).take(2)
        if len(rows) != 1:
            found = "no" if not rows else "more than one"
            raise ValueError(f"{found} store entry for table_id {table_id!r}")
        return rows[0]

    def with_legal_status(self, rows: DataFrame, source: str, out: str) -> DataFrame:
        """Standard legal status by source value, NULL where the dictionary has none."""
        entries = self.mapping.where(
            (F.col("dict_code") == C.LEGAL_STATUS_DICT) & (F.col("is_valid") == 1)
        ).select(F.col("source_value").alias("_source"), F.col("standard_value").alias(out))
        joined = lookup_join(
            rows, entries, F.col(source), F.col("_source"), small=self.small("mapping")
        )
        return joined.drop("_source")

    def with_language(self, rows: DataFrame, source: str, out: str) -> DataFrame:
        """Two-letter language code by the first, then by the second three-letter code."""
        small = self.small("language")
        for i, column in enumerate(("iso639_2", "iso639_2_b"), 1):
            entries = self.language.select(
                F.col(column).alias(f"_code{i}"), F.col("iso639_1").alias(f"_lang{i}")
            )
            rows = lookup_join(rows, entries, F.col(source), F.col(f"_code{i}"), small=small)
        found = F.coalesce("_lang1", "_lang2").alias(out)
        return rows.select("*", found).drop("_code1", "_lang1", "_code2", "_lang2")

    def with_country(self, rows: DataFrame, source: str) -> DataFrame:
        """``_country_hit`` and ``_country_name`` by a code compared without case and accents.

        The key is made unique first, so rows are never multiplied.
        """
        entries = (
            self.country.where(F.col("country_code").isNotNull())
            .groupBy(F.collate("country_code", C.COUNTRY_COLLATION).alias("_code"))
            .agg(F.min("country_name_cn").alias("_country_name"))
            .withColumn("_country_hit", F.lit(True))
        )
        # The key is a column of its own: Spark turns collated columns into hashable keys, but not
        # collated expressions, and would sort both sides instead.
        keyed = rows.withColumn("_country_key", F.collate(source, C.COUNTRY_COLLATION))
        joined = lookup_join(
            keyed, entries, F.col("_country_key"), F.col("_code"), small=self.small("country")
        )
        return joined.drop("_code", "_country_key")
