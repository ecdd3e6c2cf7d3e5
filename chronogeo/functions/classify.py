"""Text classifiers as ordered CASE expressions over word patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import trimmed, words


def _any(terms: str) -> str:
    """A pattern of any of the given terms; '_' stands for a space inside a term."""
    return "|".join(t.replace("_", " ") for t in terms.split())


#: something happened: vetoes the reading as an institution
INCIDENT = _any(
    "arson assassination attack avalanche bankruptcy battle blast bombing boycott catastrophe closure collapse controversy crash cyclone "
    "demonstration derailment disaster dissolution earthquake epidemic eruption explosion famine fire flood hurricane invasion killing "
    "landslide lawsuit lockout massacre murder outbreak pandemic protest raid revolt riot scandal shooting siege sinking strike tornado "
    "tragedy trial uprising walkout war wreck"
)
#: something stands: deliberately without societies, parties and international bodies
INSTITUTION = _any(
    "abbey academy airline aquarium arboretum archive arena art_gallery asylum bank baseball_team basilica basketball_team botanical_garden "
    "brand brewery broadcaster bus_company casino cathedral chain chapel church cinema clinic college company concert_hall conglomerate "
    "conservatory convent corporation cricket_club department_store diocese distillery factory film_studio firm football_club foundry "
    "gymnasium hospital hotel ice_hockey_team infirmary inn insurer library magazine manufacturer medical_cent(?:er|re) mill monastery "
    "mosque museum newspaper observatory opera_house parish periodical planetarium polytechnic priory publisher publishing_house racecourse "
    "radio_(?:channel|network|station) railway_company record_label refinery restaurant retailer rugby_club sanatorium school schools "
    "seminary shipping_line shipyard shopping_(?:center|centre|mall) sports_club sports_team stadium synagogue tabloid "
    "television_(?:channel|network|station) temple theater theatre university winery zoo"
)
SETTLEMENT = _any(
    "borough capital_(?:city_)?of census-designated_place cities city commune hamlet locality metropolis municipality neighborhood "
    "neighbourhood settlement suburb town township unincorporated_(?:area|community) urban_(?:area|district) village"
)
SOVEREIGN = _any("independent_(?:country|nation|state) sovereign_state")
SUBNATIONAL = _any(
    "administrative_(?:division|region|territorial_entity|unit) autonomous_(?:community|region|republic) canton county department_(?:in|of) "
    "district federal_state governorate krai oblast okrug parish prefecture province region_(?:in|of) "
    "republic_(?:in|of)_(?:russia|the_russian_federation|the_soviet_union|the_ussr) state_(?:in|of) territory_(?:in|of) voivodeship"
)
COUNTRY = _any("caliphate confederation country empire kingdom_(?:in|of) nation republic_(?:in|of)")
PHRASED = _any(
    "admission admitted charter chartered created creation discover discovered discovery establish established establishment found "
    "foundation founded founding incorporated incorporation statehood"
)
US_STATE = r"u\.?s\.?\s+(?:federated )?state|state (?:in|of) the united states"
KIND_WORDS = {
    "treaty": _any("accord convention pact treaty"),
    "conflict": _any("battle invasion siege war"),
    "founding": _any("declares established founded gains independence secedes"),
}


def head_phrase(blurb: Column) -> Column:
    return F.substring(trimmed(F.element_at(F.split(F.lower(blurb), ","), 1)), 1, 80)


def is_institution(blurb: Column) -> Column:
    """The blurb describes a standing institution, not something that happened. Null and empty: false."""
    return F.coalesce(~words(INCIDENT, F.lower(blurb)) & words(INSTITUTION, head_phrase(blurb)), F.lit(False))


def founding_kind(blurb: Column) -> Column:
    """institution, settlement, country or subnational by the first rule that fits; null if none does."""
    b = F.lower(blurb)
    return (
        F.when(is_institution(blurb), "institution").when(words(SETTLEMENT, b), "settlement").when(words(SOVEREIGN, b), "country")
        .when(words(SUBNATIONAL, b), "subnational").when(words(COUNTRY, b), "country")
    )


def category_of(text: Column) -> Column:
    t = F.lower(text)
    return F.when(words(KIND_WORDS["treaty"], t), "treaty").when(words(KIND_WORDS["conflict"], t), "conflict").when(words(KIND_WORDS["founding"], t), "founding").otherwise("event")


def display_rule(title: Column, blurb: Column, category: Column, kind: Column) -> Column:
    """The rule by which a row gets a phrased title; null where it keeps its own."""
    name = trimmed(title)
    founding = (
        F.when(kind == "settlement", "settlement").when((kind == "subnational") & F.coalesce(F.lower(blurb).rlike(US_STATE), F.lit(False)), "statehood")
        .when(kind == "subnational", "subnational").when(kind == "country", "country").otherwise("founding-unclassified")
    )
    rule = F.when(category == "discovery", "discovery").when(category == "founding", founding)
    return F.when((name != "") & ~words(PHRASED, F.lower(name)), rule)


def display_title(title: Column, rule: Column) -> Column:
    name = trimmed(title)
    return F.when(rule == "discovery", F.concat(F.lit("Discovery of "), name)).when(rule == "statehood", F.concat(name, F.lit(" Statehood"))).when(rule.isNotNull(), F.concat(F.lit("Founding of "), name))
