"""What a preparing step hands back: good rows, refused rows, notes and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

TOTALS = ("total_input", "total_ingested", "total_errored", "difference_ingested_vs_errored")


def known_codes(df: DataFrame) -> list[str]:
    """The refusal codes that the steps behind a judged frame can give, as ``refuse`` notes them on the column."""
    return df.schema["reject_code"].metadata.get("codes", [])


@dataclass(frozen=True)
class Result:
    """One judged frame and the views a caller asks for.

    ``judged`` holds every input row with ``reject_code``, ``reject_message``
    and, where the step has them, ``warnings`` (array of code and message). The
    views are filters over it, so nothing is computed until one is used, and a
    caller who needs several can write ``judged`` once and split on read.

    A row with a ``fatal`` code ends the job that meets it, in every view but
    ``judged`` and ``metrics``: what such a job was writing is not committed.
    """

    judged: DataFrame
    fatal: tuple[str, ...] = ()

    def stop_on(self, *codes: str) -> Result:
        """The same rows, of which one with any of these codes ends the job."""
        return replace(self, fatal=(*self.fatal, *codes))

    def _guarded(self, wanted: Column) -> Column:
        if not self.fatal:
            return wanted
        told = F.concat(F.col("reject_code"), F.lit(": "), F.coalesce("reject_message", F.lit("")))
        return F.when(F.col("reject_code").isin(*self.fatal), F.raise_error(told).cast("boolean")).otherwise(wanted)

    @property
    def checked(self) -> DataFrame:
        """All rows, as they are to be written."""
        return self.judged.filter(self._guarded(F.lit(True))) if self.fatal else self.judged

    @property
    def valid(self) -> DataFrame:
        return self.judged.filter(self._guarded(F.col("reject_code").isNull())).drop(
            "reject_code", "reject_message", "warnings"
        )

    @property
    def rejects(self) -> DataFrame:
        return self.judged.filter(self._guarded(F.col("reject_code").isNotNull()))

    def samples(self, order: Sequence[str], k: int = 5) -> DataFrame:
        """The first ``k`` refused rows of each code by ``order``, which should be total, as ``sample_number`` 1 to k.

        The rank filter is cut in every map task: a code with very many rows sends k of each.
        """
        first = Window.partitionBy("reject_code").orderBy(*[F.asc_nulls_first(c) for c in order])
        return self.rejects.withColumn("sample_number", F.row_number().over(first)).filter(F.col("sample_number") <= k)

    def observed(self, **also: Column) -> tuple[DataFrame, Observation]:
        """``checked``, counted while some job runs over it.

        Afterwards the observation has ``total_input``, ``total_ingested``, a count for every
        known code and for unknown ones, and the bare aggregates ``also``.
        """
        code, codes, seen = F.col("reject_code"), known_codes(self.judged), Observation()
        counts = {"total_input": F.count(F.lit(1)), "total_ingested": F.count_if(code.isNull())}
        counts |= {f"rejected_{c}": F.count_if(F.coalesce(code == c, F.lit(False))) for c in codes}
        counts["unknown"] = F.count_if(code.isNotNull() & ~code.isin(*codes)) if codes else F.count_if(code.isNotNull())
        return self.checked.observe(seen, *[c.alias(n) for n, c in (counts | also).items()]), seen

    @property
    def warnings(self) -> DataFrame:
        if "warnings" not in self.judged.columns:
            none = F.lit(None).cast("array<struct<code:string,message:string>>")
            return replace(self, judged=self.judged.withColumn("warnings", none)).warnings
        kept = self.judged.filter(self._guarded(F.col("reject_code").isNull()))
        rest = [c for c in kept.columns if c not in ("warnings", "reject_code", "reject_message")]
        return kept.select(*rest, F.explode("warnings").alias("warning")).select(
            *rest,
            F.col("warning.code").alias("warning_code"),
            F.col("warning.message").alias("warning_message"),
        )

    @property
    def metrics(self) -> DataFrame:
        """Rows in, rows kept, rows refused, and one row per refusal code."""
        code = F.coalesce("reject_code", F.lit(""))
        counts = self.judged.groupBy(code.alias("outcome")).agg(F.count("*").alias("records"))
        # Each outcome's count goes into every metric that it is part of: the rows are judged once.
        kept, n = F.col("outcome") == "", F.col("records")

        def metric(name: Column | str, value: Column) -> Column:
            return F.struct((F.lit(name) if isinstance(name, str) else name).alias("metric"), value.alias("records"))

        parts = F.array(
            metric("total_input", n),
            metric("total_ingested", F.when(kept, n).otherwise(0)),
            metric("total_errored", F.when(kept, 0).otherwise(n)),
            metric("difference_ingested_vs_errored", F.when(kept, n).otherwise(-n)),
            metric(F.when(~kept, F.concat(F.lit("rejected_"), "outcome")), n),
        )
        zeros = self.judged.sparkSession.createDataFrame([(m, 0) for m in TOTALS], "metric string, records long")
        rows = counts.select(F.explode(parts).alias("part")).select("part.*").filter("metric IS NOT NULL")
        return rows.unionByName(zeros).groupBy("metric").agg(F.sum("records").alias("records"))


def observed_metrics(values: Mapping[str, object]) -> list[tuple[str, int]]:
    """What an observation of a result saw, in the rows of ``Result.metrics``."""
    if values.get("unknown"):
        raise ValueError("rows were refused with codes that no step has noted")
    n, kept = values.get("total_input", 0), values.get("total_ingested", 0)
    totals = list(zip(TOTALS, (n, kept, n - kept, kept - (n - kept))))
    return totals + [(m, v) for m, v in values.items() if m.startswith("rejected_") and v]
