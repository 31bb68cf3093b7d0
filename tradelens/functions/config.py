"""Weights of the two scoring generations: ``v2`` (current) and ``v1`` (archive). Fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    role_weight: dict = field(default_factory=lambda: {"ceo": 1.0, "cfo": 0.95, "chair": 0.9, "president": 0.85, "coo": 0.8, "officer_other": 0.5})
    buy_weight: float = 1.0
    sell_weight: float = 0.0
    planned_discount: float = 0.05
    indirect_weight: float = 0.6
    decay: float = 0.693
    insider_half_life: float = 45.0
    staleness: str = "decay"
    legislator_half_life: float = 60.0
    owner_weight: dict = field(default_factory=lambda: {"self": 1.0, "spouse": 0.8, "joint": 0.9, "dependent": 0.5, "managed": 0.0})
    owner_default: float = 0.3
    saturation: float = 0.30
    conviction: float = 0.25
    member_cap: float = 0.05
    winsor: float = 0.95
    windows: tuple = (30, 90, 180)
    both_sides_boost: float = 1.0


V2 = Config()
V1 = Config(sell_weight=-0.5, planned_discount=0.25, staleness="steps", owner_weight={"self": 1.0, "spouse": 0.8, "joint": 0.9, "dependent": 0.5, "managed": 0.3}, both_sides_boost=1.1)

PLANNED = ("10b5-1", "10b-5-1", "rule 10b5", "rule 10b-5", "trading plan", "pre-arranged", "pre-established")
ENTITY_WORDS = ("llc", "llp", "lp", "trust", "foundation", "fund", "capital", "partners", "advisors", "holdings", "inc", "corp", "ltd", "group", "associates", "investment")
BRACKETS = [
    ("$1,001 - $15,000", 1_001, 15_000), ("$15,001 - $50,000", 15_001, 50_000), ("$50,001 - $100,000", 50_001, 100_000),
    ("$100,001 - $250,000", 100_001, 250_000), ("$250,001 - $500,000", 250_001, 500_000), ("$500,001 - $1,000,000", 500_001, 1_000_000),
    ("$1,000,001 - $5,000,000", 1_000_001, 5_000_000), ("$5,000,001 - $25,000,000", 5_000_001, 25_000_000),
    ("$25,000,001 - $50,000,000", 25_000_001, 50_000_000), ("Over $50,000,000", 50_000_001, 100_000_000),
]
COMMITTEE_SECTORS = {
    "ssba": ["Financials"], "ssas": ["Industrials"], "sshr": ["Health Care"], "sseg": ["Energy"], "ssga": ["Industrials"], "sscm": ["Communication Services"],
    "ssev": ["Utilities"], "ssaf": ["Consumer Staples"], "ssfr": ["Financials"], "sssb": ["Industrials", "Consumer Discretionary"], "ssfi": ["Financials"],
    "hsba": ["Financials"], "hsas": ["Industrials"], "hsif": ["Health Care", "Energy", "Communication Services"], "hsag": ["Consumer Staples"], "hsap": ["Financials"],
    "hshm": ["Industrials"], "hssy": ["Technology", "Industrials"], "hssm": ["Industrials", "Consumer Discretionary"], "hswm": ["Health Care", "Financials"], "hsbu": ["Financials"],
}
