"""Every registered query of this package, with its oracle where there is one."""

from __future__ import annotations

from palimpsest.llm import bpe, decontaminate, exact_dedup, langid, lattice, line_dedup, mixing, quality, simhash, spelling, url_filter, warc, whitening  # noqa: F401
from palimpsest.llm.common import ORACLES, QUERIES  # noqa: F401
