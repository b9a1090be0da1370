"""Series parameters, vocabularies and lookup values shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SeriesConfig:
    """The one place where the boundary of a survey series is stated."""

    series_start: str
    commissioning: tuple[str, ...]
    derived_schema_id: str = "survey-derived/1"
    extractor_version: str = "quietband-enrich/1"
    decoder_version: str = "quietband-frames/1"


# --- Fixed values: state vocabularies -------------------------------------------------

COMMISSIONING = "commissioning_reference"
PILOT = "pilot_series"
OUTSIDE = "outside_series"

COMPLETED = "completed_sweep"
SKIPPED = "skipped_no_interface"
FAILED = "failed"
RUNNING = "running"
MALFORMED = "malformed"
MISSING_SLOT = "missing_hourly_slot"
ATTEMPT_STATES = (COMPLETED, SKIPPED, FAILED, RUNNING, MALFORMED, MISSING_SLOT)

SAMPLE_STATUSES = ("sampled", "sampled_empty", "regulatory_skip", "capture_error")

SINGLE = "single_occurrence"
MULTI = "unpaired_multi_occurrence"

HIDDEN = "<hidden>"
BANDS = ("2.4GHz", "5GHz", "6GHz")

# Values of the disabled-link cell that mean "disabled".  The metric views and the capture
# census use different vocabularies, and both are kept.
VIEW_DISABLED_VALUES = ("True", "true", "1")
CENSUS_DISABLED_VALUES = ("1", "true", "yes", "set")

# Tables an extraction status may contribute to the published views.
CORE_TABLES = ("run", "frequencies", "observations")
ADVANCED_TABLES = ("ie_capabilities", "rnr", "bss_load", "field_resolution")
DERIVED_TABLES = CORE_TABLES + ADVANCED_TABLES

# Names of the published views and the briefing sections, in order.
VIEW_NAMES = (
    "pilot_runs",
    "pilot_frequencies",
    "pilot_observations",
    "pilot_ie_capabilities",
    "pilot_rnr",
    "pilot_bss_load",
    "pilot_field_resolution",
    "pilot_run_health",
    "pilot_hourly_metrics",
    "pilot_band_metrics",
    "pilot_capability_metrics",
    "pilot_6ghz_evidence",
)
BRIEFING_SECTIONS = (
    "Scope and cutoff",
    "Collection health",
    "Coverage",
    "Longitudinal snapshot",
    "Capability advertisements",
    "RNR and 6 GHz evidence",
    "BSS Load",
    "Data-quality findings",
    "Commissioning reference",
    "Provenance",
)
RECENT_RUNS = 12

# --- Fixed values: texts of run health, inventories and update reports --------------------
# They are cells of published views and exports, which consumers compare with earlier ones, so they have to be these.

REASONS = {
    "not_a_timestamp": "directory name is not a run timestamp",
    "not_a_directory": "not a directory",
    "commissioning": "named commissioning/reference run; predates instrument.json and the approved series start",
    "before_start": "predates the approved series start {start} and is not a named commissioning run",
    "no_instrument": "instrument.json missing or unreadable",
    "running": "run in progress at last instrument write",
    "skipped": "receiver absent at run start; skip record written",
    "skipped_incomplete": "receiver absent but skip record incomplete",
    "failed": "collector exited before completing the sweep",
    "completed": "instrument records a completed sweep with parseable manifest and aggregate",
    "sweep_without_tables": "run_status=sweep but frequencies.tsv or aggregate.tsv is missing or unreadable",
    "missing_slot": "expected hourly slot with no attempt in the pilot tree",
    "no_manifest": "no derivation manifest",
    "failed_before": "prior derivation failed",
    "schema_changed": "derived schema changed",
    "extractor_changed": "extractor version changed",
    "source_changed": "source identity changed",
    "outputs_changed": "derived outputs no longer match the manifest",
    "deferred": "run in progress; enrichment deferred",
}
DETECTED = "detected"
LINK_DISABLED = "administratively_disabled"
NOT_OBSERVED = "advertised_but_not_observed_in_nonconcurrent_dwell"
# Checks of the identity census: name -> the element whose frames it counts.
ELEMENT_CHECKS = {
    "element_71_multiple_bssid": 71,
    "element_201_rnr": 201,
    "element_11_bss_load": 11,
    "element_195_tx_power_envelope": 195,
    "element_244_rsnx": 244,
    "element_107_interworking": 107,
}

# --- Fixed values: measurement constants ------------------------------------------------

TU_SECONDS = 0.001024
DEFAULT_DWELL_SECONDS = 10
THIN_BEACONS = 10
RSSI_SPREAD_DB = 15
EMPTY_CAPTURE_BYTES = 24
RADIOTAP_LINK_TYPE = 127

# --- Fixed values: 802.11 element and extension identifiers -----------------------------

TAG_SSID = 0
TAG_BSS_LOAD = 11
TAG_RNR = 201
TAG_EXTENSION = 255

CAPABILITY_TAGS = {
    "has_ht": (45,),
    "has_vht": (191,),
    "has_multiple_bssid": (71,),
    "has_rnr": (201,),
    "has_bss_load": (11,),
    "has_rsn": (48,),
    "has_extended_capabilities": (127,),
}
CAPABILITY_EXTENSIONS = {
    "has_he": (35, 36),
    "has_he_6ghz": (59,),
    "has_eht": (106, 108),
    "has_mld": (107,),
}
CAPABILITY_COLUMNS = (
    "has_ht", "has_vht", "has_he", "has_he_6ghz", "has_eht", "has_mld",
    "has_multiple_bssid", "has_rnr", "has_bss_load", "has_rsn",
    "has_extended_capabilities",
)
GENERATIONS = (
    ("HE / Wi-Fi 6", (35, 36)),
    ("HE 6 GHz / Wi-Fi 6E", (59,)),
    ("EHT / Wi-Fi 7", (106, 107, 108)),
)
PRIORITY_ELEMENTS = (201, 71, 11, 48, 255, 127, 45, 191)
UNMAPPED = "UNMAPPED - look up before reporting"

ELEMENT_NAMES = {
    0: "SSID", 1: "Supported Rates", 3: "DS Parameter Set", 5: "TIM", 7: "Country",
    11: "BSS Load", 32: "Power Constraint", 33: "Power Capability", 35: "TPC Report",
    36: "Supported Channels", 37: "Channel Switch Announcement", 42: "ERP Information",
    45: "HT Capabilities", 46: "QoS Capability", 48: "RSN", 50: "Extended Supported Rates",
    51: "AP Channel Report", 52: "Neighbor Report", 54: "Mobility Domain",
    55: "Fast BSS Transition", 59: "Supported Operating Classes", 61: "HT Operation",
    62: "Secondary Channel Offset", 70: "RM Enabled Capabilities", 71: "Multiple BSSID",
    72: "20/40 BSS Coexistence", 74: "Overlapping BSS Scan Params", 107: "Interworking",
    108: "Advertisement Protocol", 111: "Roaming Consortium", 113: "Mesh Configuration",
    127: "Extended Capabilities", 191: "VHT Capabilities", 192: "VHT Operation",
    193: "Extended BSS Load", 194: "Wide Bandwidth Channel Switch",
    195: "Transmit Power Envelope", 196: "Channel Switch Wrapper", 198: "Quiet Channel",
    199: "Operating Mode Notification", 201: "Reduced Neighbor Report",
    221: "Vendor Specific", 240: "Fine Timing Measurement Params", 244: "RSNX",
    255: "Element Extension",
}
EXTENSION_NAMES = {
    35: "HE Capabilities", 36: "HE Operation", 38: "HE MU EDCA Parameter Set",
    39: "Spatial Reuse Parameter Set", 55: "Multiple BSSID Configuration",
    59: "HE 6 GHz Band Capabilities", 106: "EHT Operation", 107: "Multi-Link",
    108: "EHT Capabilities", 109: "TID-to-Link Mapping",
}

# Named bits of the neighbor BSS-parameters byte, lowest bit first.
BSS_PARAMETER_BITS = (
    "OCT recommended",
    "same SSID",
    "multiple BSSID",
    "transmitted BSSID",
    "member of ESS w/ 2.4-5 GHz co-located AP",
    "unsolicited probe responses active",
    "co-located AP",
)

# --- Fixed values: SSID naming patterns, in matching order ------------------------------

DEFAULT_SSID_PATTERNS = (
    ("charter_spectrum", "^SpectrumSetup-"),
    ("att", "^ATT-WIFI-"),
    ("verizon", "^Verizon_"),
    ("breezeline", "^Breezeline"),
    ("centurylink", "^CenturyLink"),
    ("netgear_oem", "^NETGEAR[0-9]*$"),
    ("vendor_oem", "^(TP-Link|Linksys|ASUS|Xfinity)"),
)
SHARED_SSID_PATTERNS = (
    ("charter_community", "^Spectrum Mobile$"),
    ("comcast_community", "^xfinitywifi$"),
    ("altice_community", "^optimumwifi$"),
)

# --- Fixed values: logical field -> candidate dissector fields, in preference order -----

FIELD_CANDIDATES = {
    "rnr_op_class": (
        "wlan.rnr.tbtt_info.operating_class",
        "wlan.rnr.operating_class",
        "wlan.rnr.tbtt_info.op_class",
    ),
    "rnr_channel": (
        "wlan.rnr.tbtt_info.channel_num",
        "wlan.rnr.channel_number",
        "wlan.rnr.tbtt_info.channel_number",
    ),
    "rnr_bssid": ("wlan.rnr.tbtt_info.bssid", "wlan.rnr.bssid"),
    "rnr_short_ssid": (
        "wlan.rnr.tbtt_info.sh_ssid",
        "wlan.rnr.tbtt_info.short_ssid",
        "wlan.rnr.short_ssid",
    ),
    "rnr_bss_params": (
        "wlan.rnr.tbtt_info.bss_parameters",
        "wlan.rnr.bss_parameters",
    ),
    "rnr_mld_link_id": ("wlan.rnr.tbtt_info.mld_parameters.link_id",),
    "rnr_mld_id": ("wlan.rnr.tbtt_info.mld_parameters.mld_id",),
    "rnr_disabled_link": (
        "wlan.rnr.tbtt_info.mld_parameters.disabled_link_indication",
    ),
    "qbss_station_count": ("wlan.qbss.scount", "wlan.qbss2.scount"),
    "qbss_utilization": ("wlan.qbss.cu", "wlan.qbss2.cu"),
    "qbss_admission": ("wlan.qbss.adc",),
    "he_bss_color": ("wlan.ext_tag.bss_color_information.bss_color",),
    "ext_tag_number": ("wlan.ext_tag.number", "wlan.ext_tag"),
    "beacon_timestamp": ("wlan.fixed.timestamp",),
    "radiotap_tsft": ("radiotap.mactime",),
    "radiotap_noise": ("radiotap.dbm_antnoise",),
    "radiotap_db_noise": ("radiotap.db_antnoise",),
    "radiotap_dbm_signal": ("radiotap.dbm_antsignal",),
    "radiotap_db_signal": ("radiotap.db_antsignal",),
    "radiotap_antenna": ("radiotap.antenna",),
    "radiotap_datarate": ("radiotap.datarate",),
    "radiotap_mcs_index": ("radiotap.mcs.index",),
    "radiotap_vht_nss": (
        "radiotap.vht.nss.0",
        "radiotap.vht.nss.1",
        "radiotap.vht.nss.2",
        "radiotap.vht.nss.3",
        "radiotap.vht.nss",
        "radiotap.vht.user0.nss",
    ),
    "radiotap_he_data1": (
        "radiotap.he.data_1.ppdu_format",
        "radiotap.he.data1",
        "radiotap.he.ppdu_format",
    ),
    "radiotap_flags_badfcs": ("radiotap.flags.badfcs",),
    "frame_number": ("frame.number",),
    "frame_time_epoch": ("frame.time_epoch",),
    "wlan_bssid": ("wlan.bssid",),
    "wlan_ssid": ("wlan.ssid",),
    "tag_number": ("wlan.tag.number",),
}

# Radiotap fields reported by the population probe, in report order.
RADIOTAP_PROBE = (
    "radiotap_tsft",
    "radiotap_dbm_signal",
    "radiotap_db_signal",
    "radiotap_noise",
    "radiotap_db_noise",
    "radiotap_antenna",
    "radiotap_datarate",
    "radiotap_mcs_index",
    "radiotap_vht_nss",
    "radiotap_he_data1",
    "radiotap_flags_badfcs",
)

# Neighbor-report cells: logical field -> derived column.
RNR_CELLS = {
    "rnr_op_class": "op_class",
    "rnr_channel": "channel",
    "rnr_bssid": "neighbor_bssid",
    "rnr_short_ssid": "short_ssid",
    "rnr_bss_params": "bss_params",
    "rnr_mld_link_id": "mld_link_id",
    "rnr_mld_id": "mld_id",
    "rnr_disabled_link": "disabled_link",
}
LOAD_CELLS = {
    "qbss_station_count": "station_count",
    "qbss_utilization": "utilization",
    "qbss_admission": "admission_capacity",
}
