"""Instrument rules: which one an id means, its defaults, its log names.

The rules are a short fixed list, so they become a ``CASE`` over the id; no
join is needed. A new instrument is one more entry.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Instrument:
    """One instrument: names it goes by, default values, log names by preference."""

    name: str
    aliases: tuple[str, ...] = ()
    facility: str = "SNS"
    laboratory: str = "ORNL"
    probe: str = "neutrons"
    technique: str = "reflectivity"
    technique_description: str | None = None
    environment_description: str = "Sample cell"
    wavelength: float | None = None
    wavelength_spread: float | None = None
    temperature_logs: tuple[str, ...] = ()
    pressure_logs: tuple[str, ...] = ()
    zero_is_missing: bool = False


# The known instruments, then the one for unknown ids.
KNOWN = (
    Instrument(
        name="REF_L",
        aliases=("BL4B", "BL-4B"),
        technique_description="Specular neutron reflectometry",
        wavelength=6.0,
        wavelength_spread=0.02,
        temperature_logs=("SampleTemp",),
        zero_is_missing=True,
    ),
)
GENERIC = Instrument(
    name="GENERIC",
    temperature_logs=("SampleTemp", "Temperature", "Temp", "sample_temperature"),
    pressure_logs=("Pressure", "VacuumPressure", "sample_pressure"),
)


def resolve(instrument_id: Column, known: tuple[Instrument, ...] = KNOWN) -> Column:
    """Name of the instrument an id means.

    An exact name or alias comes first, then one contained in the id, then the
    generic instrument.
    """
    upper = F.upper(instrument_id)
    pick = F
    for rule in known:
        pick = pick.when(instrument_id.isin(rule.name, *rule.aliases), F.lit(rule.name))
    for rule in known:
        for text in (rule.name, *rule.aliases):
            pick = pick.when(upper.contains(text.upper()), F.lit(rule.name))
    return pick.otherwise(F.lit(GENERIC.name))


def default_of(name: Column, attribute: str, known: tuple[Instrument, ...] = KNOWN) -> Column:
    """Default value of an instrument, given its resolved name."""
    pick = F
    for rule in known:
        pick = pick.when(name == rule.name, F.lit(getattr(rule, attribute)))
    return pick.otherwise(F.lit(getattr(GENERIC, attribute)))


def log_names(known: tuple[Instrument, ...] = KNOWN) -> list[str]:
    """Every log name some instrument reads."""
    names: dict[str, None] = {}
    for rule in (*known, GENERIC):
        names.update(dict.fromkeys((*rule.temperature_logs, *rule.pressure_logs)))
    return list(names)


def log_value(log: Column, prefer_average: bool = True) -> Column:
    """Value of one log record: its average unless missing, else its number."""
    number = log["value_numeric"]
    if not prefer_average:
        return number
    average = log["average_value"]
    return F.coalesce(F.when(~F.isnan(average), average), number)


def preferred(logs: Column, names: tuple[str, ...], zero_is_missing: bool = False) -> Column:
    """First value among the names, in order; ``logs`` maps names to values."""
    values = [F.try_element_at(logs, F.lit(name)) for name in names]
    if zero_is_missing:
        values = [F.nullif(value, F.lit(0.0)) for value in values]
    return F.coalesce(*values) if values else F.lit(None).cast("double")


def environment_value(
    name: Column, logs: Column, attribute: str, known: tuple[Instrument, ...] = KNOWN
) -> Column:
    """Temperature or pressure of a run, by its instrument's own log names."""
    pick = F
    for rule in known:
        pick = pick.when(
            name == rule.name, preferred(logs, getattr(rule, attribute), rule.zero_is_missing)
        )
    return pick.otherwise(preferred(logs, getattr(GENERIC, attribute), GENERIC.zero_is_missing))
