"""Text tables of any number of sweeps to named profile relations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quietband.operators import profile as P
from quietband.operators import sweep_summary as S


def profile_sweeps(frequencies: DataFrame, observations: DataFrame) -> dict[str, DataFrame]:
    """All profile sections; a sweep without observations simply has no rows in theirs."""
    features = P.observation_features(observations)
    totals = S.sweep_totals(frequencies)
    return {
        "window": P.sweep_window(observations),
        "coverage": P.coverage(frequencies),
        "coverage_by_band": P.coverage_by_band(frequencies),
        "state_by_outcome": P.state_by_outcome(frequencies),
        "positive_control": P.positive_control(frequencies),
        "reception_bounds": P.reception_bounds(observations, frequencies),
        "identity": P.identity_summary(features),
        "radio_families": P.radio_families(features),
        "radio_family_names": P.radio_family_names(features),
        "ssid_profile": P.ssid_profile(features),
        "shared_services": P.shared_services(features),
        "provider_counts": P.provider_counts(features),
        "rf_profile": P.rf_profile(observations),
        "channel_occupancy": P.channel_occupancy(observations),
        "multi_frequency": P.multi_frequency_addresses(observations),
        "quality_flags": P.quality_flags(observations, frequencies),
        "per_frequency": S.per_frequency(observations),
        "sweep_totals": totals,
        "addresses_by_band": S.addresses_by_band(observations),
        "verdict": S.sweep_verdict(totals),
        "features": features,
    }
