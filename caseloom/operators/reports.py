"""Named reports and the published views they read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.session import shuffles_removed
from ..sources.sinks import save_parquet
from . import derive
from .clean import DATA_HUB_COLUMNS, Cleaning, final_clean, report_columns
from .impute import SOURCES, impute_dates

# The view each report selects, and what it leaves out.
REPORT_VIEWS = {
    "WHO": ("who", []),
    "StatsCan": ("statscan", []),
    "DataHub": ("data_hub", []),
    "HCDaily": ("data_hub", ["pt"]),
    "Domestic surveillance": ("modelling_data", []),
    "qry_allcases_web": ("all_cases_web", []),
    "qry_allcases": ("all_cases", []),
}


def all_cases(df: DataFrame) -> DataFrame:
    """The case table with every derived column; a single projection."""
    return df.withColumns(
        {
            "episodetype": derive.episode_type(),
            "hospstatus": derive.hosp_status(),
            "hospitalized": derive.hospitalized(),
            "intensivecareunit": derive.icu_flag(),
            "death": derive.death_flag(),
            "sexgender2": derive.sex2(),
            "occupation2": derive.occupation2(),
            "healthcare_worker2": derive.healthcare_worker2(),
            "ltc_resident2": derive.ltc_resident2(),
            "indigenous2": derive.indigenous2(),
            "onsetdate2": derive.onset_date_text(),
            "disposition2": derive.disposition2(),
            "resolutiondate2": derive.recovery_date2(),
            "exposure_cat2": derive.exposure_cat2(),
            "exposurecountry": derive.exposure_country(df),
            **derive.comorbidity_columns(df),
            **derive.asymptomatic_columns(df),
        }
    )


def keep_columns(df: DataFrame, columns: Iterable[str], path: str) -> DataFrame:
    """Columns of a table, computed once and stored, for a batch whose reports read a few of them each.

    A name that comes twice is stored once. The caller removes the folder after the batch.
    """
    names = list({c.lower(): c for c in columns}.values())
    kept = df.select(*[F.col(f"`{c}`") for c in names])
    with shuffles_removed(df.sparkSession):
        save_parquet(kept, path)
    return df.sparkSession.read.schema(kept.schema).parquet(path)


def publish_views(cases: DataFrame, columns: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Register the published views as projections of the derived case table.

    A view that is not listed has every column. Views are lazy: each extract reads only its
    columns, and derives them anew unless the table was stored by :func:`keep_columns`.
    """
    views = {}
    for name in dict.fromkeys(v for v, _ in REPORT_VIEWS.values()):
        views[name] = cases.select(*columns[name]) if name in columns else cases
        views[name].createOrReplaceTempView(name)
    return views


def report(views: dict[str, DataFrame], name: str) -> DataFrame:
    view, without = REPORT_VIEWS[name]
    return views[view].drop(*without)


def _after(cols: list[str], new: dict[str, str]) -> list[str]:
    """Place each new column after the one it belongs to."""
    out = []
    for c in cols:
        out.append(c)
        if c in new:
            out.append(new[c])
    return out


def data_hub(
    df: DataFrame,
    *,
    cols: list[str] = DATA_HUB_COLUMNS,
    targets: list[str] = ("onsetdate", "episodedate", "reporteddate"),
    sources: list[str] = tuple(c for c in SOURCES if c != "earliestdate"),
    **kw,
) -> DataFrame:
    """Fixed projection with imputed dates next to the dates they complete."""
    out = impute_dates(df, list(targets), list(sources), **kw)
    return out.select(*_after(list(cols), {t: f"{t}_imputed" for t in targets}))


def data_hub_full(
    df: DataFrame, config: list[Cleaning], *, name: str = "DataHub", key: Column | None = None, seed: int = 0
) -> DataFrame:
    """Confirmed cases with derived columns and imputed dates, cleaned as configured.

    Imputed dates are kept even outside the observed range here.
    """
    df = df.where(F.lower("classification") == "confirmed")
    derived = df.withColumns(
        {
            "episodedate": derive.episode_date(),
            "occupation2": derive.occupation2(),
            "healthcare_worker2": derive.healthcare_worker2(),
            "asymptomatic2": derive.asymptomatic2(df),
            "onsetdate2": derive.onset_date_text(),
            "hospstatus": derive.hosp_status(),
            "disposition2": derive.disposition2(),
            "recoverydate2": derive.recovery_date2(),
            "exposure_cat2": derive.exposure_cat2(),
        }
    )
    sources = [c for c in SOURCES if c != "earliestdate"]
    imputed = impute_dates(
        derived, ["onsetdate", "episodedate"], sources, key=key, seed=seed, suppress_out_of_range=False
    )
    return final_clean(imputed, name, report_columns(config, name), config)
