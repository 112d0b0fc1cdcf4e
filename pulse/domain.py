"""Domain vocabularies.

Every operator takes column names and value lists as arguments; a ``Domain``
bundles the values a deployment needs.  Two are provided:

* ``REGISTRY`` - the values of the live business register and population
  statistics (fixed values, see below);
* ``BOUND`` - the values the synthetic test tables use once bound onto the
  canonical inputs by :mod:`pulse.sources.bindings`.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Domain:
    # legal forms -> legal group
    business_forms: tuple[str, ...]
    sole_trader_forms: tuple[str, ...]
    legal_group_labels: tuple[str, str, str]
    # population age bands -> age group
    young_bands: tuple[str, ...]
    old_bands: tuple[str, ...]
    excluded_bands: tuple[str, ...]
    age_group_labels: tuple[str, str, str]
    sex_total: str
    ethnicity_total: str
    # county naming
    county_filter_affix: str          # rows whose county carries this affix are counties
    county_filter_at: str             # 'end' | 'start' | 'anywhere'
    county_strip: str                 # removed from county names everywhere
    # classification
    old_code_version: str             # activity_version whose codes must be translated
    unassigned_label: str
    label_width: int = 60
    # loader defaults
    default_legal_form: str = "unspecified"
    default_county: str = "unspecified"
    default_status: str = "registered"
    first_entry_type: str = "first entry"
    truthy_tokens: tuple[str, ...] = ("true", "1")
    extra: dict = field(default_factory=dict)


# --- fixed values: live register / statistics vocabulary -------------------
# Legal forms counted as business companies, the sole-trader form, age bands,
# totals members, county suffix, classification version and loader defaults
# exactly as they appear in the source systems.
REGISTRY = Domain(
    business_forms=("Osaühing", "Usaldusühing", "Aktsiaselts", "Täisühing", "Tulundusühistu"),
    sole_trader_forms=("Füüsilisest isikust ettevõtja",),
    legal_group_labels=("1_äriettevõtted", "2_FIE", "3_Muud_jur_isikud"),
    young_bands=("0-4", "5-9", "10-14", "15-19"),
    old_bands=("75-79", "80-84", "85-89", "90-94", "95-99", "100 ja vanemad"),
    excluded_bands=("85 ja vanemad", "Vanuserühmad kokku"),
    age_group_labels=("1_noored_0-19", "2_ettevotlikud_20-74", "3_vanurid_75+"),
    sex_total="Mehed ja naised",
    ethnicity_total="Rahvused kokku",
    county_filter_affix="maakond",
    county_filter_at="end",
    county_strip=" maakond",
    old_code_version="EMTAK 2008",
    unassigned_label="Määramata",
    default_legal_form="Määramata",
    default_county="Määramata",
    default_status="Registris",
    first_entry_type="Esmakanne",
    truthy_tokens=("true", "jah", "1"),
)

# County dimension seed of the live deployment: name, map code, region, display order.
REGISTRY_COUNTY_SEED = (
    ("Harju", "EE-37", "Põhja-Eesti", 1),
    ("Hiiu", "EE-39", "Lääne-Eesti", 2),
    ("Ida-Viru", "EE-44", "Kirde-Eesti", 3),
    ("Jõgeva", "EE-49", "Lõuna-Eesti", 4),
    ("Järva", "EE-51", "Kesk-Eesti", 5),
    ("Lääne", "EE-57", "Lääne-Eesti", 6),
    ("Lääne-Viru", "EE-59", "Põhja-Eesti", 7),
    ("Põlva", "EE-65", "Lõuna-Eesti", 8),
    ("Pärnu", "EE-67", "Lääne-Eesti", 9),
    ("Rapla", "EE-70", "Põhja-Eesti", 10),
    ("Saare", "EE-74", "Lääne-Eesti", 11),
    ("Tartu", "EE-78", "Lõuna-Eesti", 12),
    ("Valga", "EE-82", "Lõuna-Eesti", 13),
    ("Viljandi", "EE-84", "Lõuna-Eesti", 14),
    ("Võru", "EE-86", "Lõuna-Eesti", 15),
)
# --- end of fixed values ----------------------------------------------------


# Vocabulary of the synthetic tables after binding (see sources/bindings.py).
BOUND = Domain(
    business_forms=("1-URGENT", "2-HIGH"),
    sole_trader_forms=("3-MEDIUM",),
    legal_group_labels=("1_business", "2_sole_trader", "3_other"),
    young_bands=("1", "2"),
    old_bands=("7",),
    excluded_bands=("6",),
    age_group_labels=("1_young_0-19", "2_working_20-74", "3_old_75+"),
    sex_total="R",
    ethnicity_total="O",
    county_filter_affix="NATION_",
    county_filter_at="start",
    county_strip="NATION_",
    old_code_version="V1",
    unassigned_label="unassigned",
    first_entry_type="signup",
    truthy_tokens=("true", "jah", "1"),
)

# Pinned evaluation dates (replace "today" so results are reproducible).
AS_OF = dt.date(2000, 6, 4)
FEED_AS_OF = dt.datetime(2024, 1, 15)
LEDGER_AS_OF = dt.datetime(2024, 1, 3)     # seen-ledger = state after an earlier run
CURRENT_ROLLING_YEAR = AS_OF.year
LOADED_AT = dt.datetime(2000, 6, 4, 3, 0, 0)
