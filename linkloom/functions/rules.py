"""Locale rules as data. ``register_locale`` adds to them while plans are built."""

from __future__ import annotations

from dataclasses import dataclass, field

# Words and phrases that are rewritten in names and addresses, by locale; country names and their codes.
DEFAULT_NAME = {
    "incorporated": "inc", "corporation": "corp", "corporations": "corp", "company": "co", "companies": "co", "limited": "ltd",
    "partnership": "prtnr", "associates": "assoc", "associate": "assoc", "group": "grp", "holdings": "hldg", "holding": "hldg",
    "international": "intl", "industries": "ind", "industry": "ind", "services": "svc", "service": "svc", "solutions": "sol",
    "enterprises": "ent", "enterprise": "ent", "technologies": "tech", "technology": "tech", "systems": "sys", "system": "sys",
    "management": "mgmt", "brothers": "bros", "trading": "trdg",
}
DEFAULT_ADDRESS = {
    "street": "st", "avenue": "ave", "boulevard": "blvd", "road": "rd", "drive": "dr", "lane": "ln", "place": "pl", "court": "ct",
    "terrace": "ter", "circle": "cir", "highway": "hwy", "parkway": "pkwy", "expressway": "expy", "freeway": "fwy", "way": "wy",
    "trail": "trl", "alley": "aly", "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw",
    "southeast": "se", "southwest": "sw", "suite": "ste", "apartment": "apt", "building": "bldg", "floor": "fl", "near": "nr",
    "opposite": "opp", "behind": "bhnd", "adjacent": "adj",
}
US_ADDRESS = {"route": "rte", "interstate": "i", "township": "twp"}
IN_NAME = {"society": "soc", "cooperative": "coop"}
IN_PHRASES = {"private ltd": "pvt ltd", "section 8": "s8", "co operative": "coop"}
IN_ADDRESS = {
    "nagar": "ngr", "nagara": "ngr", "marg": "mrg", "bazaar": "bazar", "beside": "adj", "sector": "sec", "phase": "ph",
    "plot": "plt", "shop": "shp", "flat": "fl", "wing": "wng", "block": "blk",
}
FR_NAME = {"association": "asso", "fondation": "fond", "groupement": "grpt"}
FR_PHRASES = {"societe anonyme": "sa", "societe a responsabilite limitee": "sarl", "micro entreprise": "me"}
FR_ADDRESS = {
    "bd": "blvd", "chemin": "chem", "route": "rte", "impasse": "imp", "passage": "pass", "villa": "vil", "residence": "res",
    "batiment": "bat", "immeuble": "imm", "appartement": "apt", "cedex": "cdx",
}
COUNTRIES = {
    "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US", "USA": "US", "INDIA": "IN", "FRANCE": "FR", "UNITED KINGDOM": "GB",
    "UK": "GB", "GREAT BRITAIN": "GB", "GERMANY": "DE", "JAPAN": "JP", "CHINA": "CN", "BRAZIL": "BR", "CANADA": "CA", "AUSTRALIA": "AU",
}
# End of the fixed values.


@dataclass(frozen=True)
class Locale:
    """Rewrites of one locale, on top of the default ones: words of names, phrases of names, words of addresses."""

    name: dict[str, str] = field(default_factory=dict)
    phrases: dict[str, str] = field(default_factory=dict)
    address: dict[str, str] = field(default_factory=dict)


DEFAULT = Locale(DEFAULT_NAME, {}, DEFAULT_ADDRESS)
_locales: dict[str, Locale] = {
    "US": Locale(address=US_ADDRESS),
    "IN": Locale(IN_NAME, IN_PHRASES, IN_ADDRESS),
    "FR": Locale(FR_NAME, FR_PHRASES, FR_ADDRESS),
}


def register_locale(code: str, locale: Locale) -> None:
    """Add or replace the rules of a country code; plans built from now on use them."""
    _locales[code.strip().upper()] = locale


def locales() -> dict[str, Locale]:
    return dict(_locales)


def rules_for(country: str) -> Locale:
    """The rules of a country, default ones included."""
    own = _locales.get((country or "").strip().upper(), Locale())
    return Locale(DEFAULT.name | own.name, DEFAULT.phrases | own.phrases, DEFAULT.address | own.address)
