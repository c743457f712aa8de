"""Engine-wide switches, shared by mapping, building and hydration."""

from __future__ import annotations

from dataclasses import dataclass, field

# Defaults a migrating user relies on.
DEFAULT_EXCLUDED = ("password",)
DEFAULT_PAGE_SIZE = 60
DATE_OUT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
DATE_IN_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'")


@dataclass(frozen=True)
class Settings:
    """Switches that apply to every mapping of a registry.

    ``index_names`` overrides the index of an entity by its full name.
    ``max_children`` bounds how many nested children one document row holds; the
    children of a larger owner are spread over several rows (see ``operators.documents``).
    """

    default_excluded_properties: tuple[str, ...] = DEFAULT_EXCLUDED
    always_inherit_properties: bool = False
    unmarshall_components: bool = True
    disable_auto_index: bool = False
    date_formats: tuple[str, ...] = DATE_IN_FORMATS
    index_names: dict[str, str] = field(default_factory=dict)
    max_children: int = 10_000
