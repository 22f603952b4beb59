"""Links and the identity fields they carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv

_YEAR_TAIL = r"-((?:19|20)\d\d)$"


def url_path(c: Column) -> Column:
    """Path of an absolute or path-only link without its outer slashes."""
    path = F.regexp_extract(c, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.trim(path, F.lit("/"))


def path_part(c: Column, position: int) -> Column:
    """1-based segment of the path, NULL when absent."""
    return F.try_element_at(F.split(url_path(c), "/"), F.lit(position))


def variant_url_fields(c: Column) -> dict[str, Column]:
    """make / model / generation / variant / year of ``/make/model/generation/variant-YYYY``.

    A path with fewer than four segments names no variant: every field is NULL.
    """
    parts = F.split(url_path(c), "/")
    whole = F.size(parts) >= 4
    part = lambda n: F.when(whole, F.try_element_at(parts, F.lit(n)))
    tail = part(4)
    return {
        "make": part(1),
        "model": part(2),
        "generation": part(3),
        "variant": F.regexp_replace(tail, _YEAR_TAIL, ""),
        "year": F.nullif(F.regexp_extract(tail, _YEAR_TAIL, 1), F.lit("")).cast("int"),
    }


def model_url_fields(url: Column, title: Column) -> dict[str, Column]:
    """make / model of ``/section/make/model/...`` and the first year named in the page title."""
    year = F.regexp_extract(F.coalesce(title, F.lit("")), r"(?:19|20)\d\d", 0)
    return {
        "make": path_part(url, 2),
        "model": path_part(url, 3),
        "year": F.nullif(year, F.lit("")).cast("int"),
    }


def bare_link(c: Column) -> Column:
    """A link without query and fragment."""
    return F.regexp_extract(c, r"^[^?#]*", 0)


def link_kind(link: Column, make: Column, model: Column | None = None) -> Column:
    """Role of a link on the pages of ``make``: model, generation, variant or NULL.

    Generation links are told from same-depth noise pages by name, and only below ``model``.
    """
    parts = F.split(F.regexp_replace(link, "/$", ""), "/")
    depth = F.when(link.startswith("/"), F.size(parts) - 1)
    own = (F.try_element_at(parts, F.lit(2)) == make) & ~F.array_contains(
        F.slice(parts, F.lit(2), F.size(parts)), "")
    name = F.try_element_at(parts, F.lit(4))
    of_model = F.lit(True) if model is None else F.try_element_at(parts, F.lit(3)) == model
    return (F.when(own & (depth == 2), F.lit("model"))
            .when(own & (depth == 4) & link.rlike(r"-(?:19|20)\d\d/?$"), F.lit("variant"))
            .when(own & (depth == 3) & of_model & ~name.isin(*fv.GENERATION_NOISE),
                  F.lit("generation")))


def is_spec_page(link: Column) -> Column:
    """Specification page of the sitemap that is not a translated mirror."""
    return link.contains("/specifications") & ~link.contains("/ms/")
