"""Display names, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Particles of family names that stay in lower case.
PARTICLES = ("van", "von", "der", "den", "de", "del", "della", "di", "da", "du", "la", "le", "ten", "ter", "vom", "zu", "of", "op")


def clean_name(c: Column) -> Column:
    """"Last, First" turned round, one-case words of three letters and more capitalised, initials upper, particles lower."""
    last, first = F.trim(F.substring_index(c, ",", 1)), F.trim(F.regexp_replace(c, "^[^,]*,", ""))
    turned = F.when((F.length(F.regexp_replace(c, "[^,]", "")) == 1) & ~c.contains("@") & (last != "") & (first != ""), F.concat(first, F.lit(" "), last)).otherwise(c)

    def fix(w: Column, i: Column) -> Column:
        bare = F.replace(w, F.lit("."), F.lit(""))
        capital = F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
        one_case = ((w == F.upper(w)) | (w == F.lower(w))) & (F.upper(w) != F.lower(w))
        return (
            F.when(w.contains("."), F.when(bare.rlike(r"^\p{L}{1,4}$"), F.upper(w)).otherwise(w))
            .when((i > 0) & F.lower(w).isin(*PARTICLES), F.lower(w))
            .when((F.length(w) >= 3) & one_case, capital)
            .otherwise(w)
        )

    words = F.filter(F.split(turned, r"(?U)\s+"), lambda w: w != "")
    return F.when(F.coalesce(c, F.lit("")) == "", c).otherwise(F.array_join(F.transform(words, fix), " "))


def name_from_address(local: Column) -> Column:
    """A name from the local part of an address; trailing ext, external and contractor dropped."""
    parts = F.filter(F.split(F.regexp_replace(local, "@.*$", ""), "[._+-]+"), lambda w: w != "")
    cut = F.when(F.lower(F.try_element_at(parts, F.lit(-1))).isin("ext", "external", "contractor") & (F.size(parts) > 1), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1)))).otherwise(parts)
    return F.initcap(F.array_join(cut, " "))


def display_name(own: Column, known: Column, address: Column, masked_domain: str = "masked.invalid") -> Column:
    """The row's own name, else one seen for the address, else the address, else "(unknown)"."""
    usable = (F.coalesce(own, F.lit("")) != "") & ~own.endswith("@" + masked_domain)
    name = F.when(usable, own).otherwise(known)
    return F.when(F.coalesce(name, F.lit("")) != "", clean_name(name)).when(F.coalesce(address, F.lit("")) != "", address).otherwise("(unknown)")
