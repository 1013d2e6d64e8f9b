"""The waterfall's lookups over landed tables, ready to be given to a run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.registry import CARE_REGISTER_MIN, CHARITY_REGISTER_MIN, COMPANY_REGISTER_MIN, best_matches, company_register_parts
from ..operators.waterfall import PRIORITY, Enricher
from ..operators.websites import enrich_from_pages, page_facts, search_contacts
from ..sources.registers import care_parts, charity_parts, charity_text_parts, model_parts, search_hits


@dataclass
class Landed:
    """What outside services answered, as tables; a missing one is a lookup that is not made.

    ``pages(url, html)``; ``register(cand_ord, title, company_number, company_type, company_status,
    registered_office_address)`` with ``officers``; ``charities(cand_ord, charity_name, ...)`` and ``charity_pages(company,
    html)`` for companies without a match; ``care(cand_ord, name, providerId, ...)`` with ``care_details``; ``searches`` and
    ``paid_searches(company, rank, link, snippet)``; ``replies(company, provider, raw_response)``. ``kind`` is the
    measure of names.
    """

    pages: DataFrame | None = None
    register: DataFrame | None = None
    officers: DataFrame | None = None
    charities: DataFrame | None = None
    charity_pages: DataFrame | None = None
    care: DataFrame | None = None
    care_details: DataFrame | None = None
    searches: DataFrame | None = None
    paid_searches: DataFrame | None = None
    replies: DataFrame | None = None
    kind: str = "sequence"

    def _matched(self, companies: DataFrame, register: DataFrame, name: str, least: float) -> DataFrame:
        """Best register row of each company, with the company's name."""
        named = register.withColumnRenamed(name, "name") if name != "name" else register
        hits = best_matches(companies, named.select("cand_ord", "name"), least, self.kind)
        return hits.select("company", "cand_ord").join(register, "cand_ord").drop("cand_ord")

    def website(self, companies: DataFrame) -> DataFrame:
        return enrich_from_pages(companies, self.pages)

    def company_register(self, companies: DataFrame) -> DataFrame:
        return company_register_parts(companies, self.register, self.officers, COMPANY_REGISTER_MIN, self.kind)

    def charity_register(self, companies: DataFrame) -> DataFrame:
        parts = charity_parts(self._matched(companies, self.charities, "charity_name", CHARITY_REGISTER_MIN))
        if self.charity_pages is None:
            return parts
        rest = companies.select("company").join(parts.select("company"), "company", "left_anti")
        text = charity_text_parts(self.charity_pages.join(rest, "company", "left_semi"))
        return parts.unionByName(text, allowMissingColumns=True)

    def care_register(self, companies: DataFrame) -> DataFrame:
        return care_parts(self._matched(companies, self.care, "name", CARE_REGISTER_MIN), self.care_details)

    def _search(self, companies: DataFrame, results: DataFrame, label: str) -> DataFrame:
        wanted = results.join(companies.select("company"), "company", "left_semi")
        facts = page_facts(self.pages) if self.pages is not None else None
        hits = search_hits(wanted)
        if facts is None:
            facts = hits.limit(0).selectExpr("link AS url", "array() :: array<string> AS phones", "array() :: array<string> AS emails", "link AS address")
        return search_contacts(hits, wanted, facts, label)

    def search(self, companies: DataFrame) -> DataFrame:
        return self._search(companies, self.searches, "duckduckgo")

    def paid_search(self, companies: DataFrame) -> DataFrame:
        return self._search(companies, self.paid_searches, "serpapi")

    def model(self, companies: DataFrame) -> DataFrame:
        return model_parts(self.replies.join(companies.select("company"), "company", "left_semi"))

    def enrichers(self) -> list[tuple[int, Enricher]]:
        """(priority, lookup) for every table that landed, in the order in which they are consulted."""
        every = [
            ("website", self.pages, self.website), ("companies_house", self.register, self.company_register),
            ("charities", self.charities, self.charity_register), ("cqc", self.care, self.care_register),
            ("duckduckgo", self.searches, self.search), ("serpapi", self.paid_searches, self.paid_search),
            ("model", self.replies, self.model),
        ]
        return [(PRIORITY[name], lookup) for name, table, lookup in every if table is not None]
