"""Values that differ between installations: brand prefixes of columns and headers, company and source codes."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Site:
    """``own`` is the prefix of the retailer's own geography columns, as in ``<own>Market``; ``code`` the short
    code in headers such as ``<code> Loc``; ``report_area`` is how the carrier's report titles name the retailer's area, if its
    title rows are to be dropped."""

    own: str = "Own"
    code: str = "OWN"
    company_cd: int = 4
    pos_system: str = "RQ4"
    transfer_system: str = "SFTP"
    sheet_system: str = "GoogleSheet"
    file_system: str = "GoogleFile"
    excluded_companies: tuple[str, ...] = ()
    report_area: str | None = None

    @property
    def levels(self) -> list[str]:
        return [f"{self.own}Market", f"{self.own}Region", f"{self.own}District"]

    def geography(self, sep: str = "") -> dict[str, str]:
        """Store columns to their lower-case fact names."""
        low = self.own.lower()
        return {f"{self.own}{x}": f"{low}{sep}{x.lower()}" for x in ("Market", "Region", "District")}

    @property
    def hierarchy(self) -> str:
        return f"{self.own} Hierarchy"


def squash(name: str) -> str:
    """Lower-case letters and digits of a header cell: ``"Email.Work.Username"`` to ``emailworkusername``."""
    return "".join(ch for ch in name if ch.isalnum() and ch.isascii()).lower()
