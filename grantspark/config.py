"""Documented defaults of every tunable; operators take them as arguments, never from the environment."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

#: The nine extracted fields in processing order.
FIELDS = (
    "valor_projeto",
    "prazo_inscricao",
    "localizacao",
    "vagas",
    "is_researcher",
    "is_company",
    "sobre_programa",
    "criterios_elegibilidade",
    "timeline_estimada",
)


@dataclass(frozen=True)
class Settings:
    as_of: date
    # listing jobs
    max_details_per_source: int = 120
    max_call_pages: int = 60
    max_call_pdfs: int = 8
    # chunk index
    chunk_size: int = 800
    chunk_overlap: int = 200
    min_text_chars: int = 50
    embed_text_chars: int = 512
    embed_batch_items: int = 8
    embed_batch_chars: int = 2048
    # retrieval
    default_top_k: int = 35
    min_top_k: int = 5
    max_top_k: int = 300
    context_chars: int = 3000
    rows_ranked: int = 1200
    rows_scan: int = 2500
    rows_audit: int = 3000
    # recommendations
    recent_notices: int = 500
    min_score: int = 25
    field_top_k: dict = field(default_factory=dict)
