"""Business rules as one immutable value, so that a run is reproducible from its inputs."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal

# Commute modes, their distance limits in metres, and contract types.
WALKING = "Marche/running"
CYCLING = "Vélo/Trottinette/Autres"
PUBLIC_TRANSPORT = "Transports en commun"
MOTOR_VEHICLE = "véhicule thermique/électrique"
ACTIVE_MODES = (WALKING, CYCLING)
KNOWN_MODES = (WALKING, CYCLING, PUBLIC_TRANSPORT, MOTOR_VEHICLE)
DISTANCE_LIMITS_M = {WALKING: 15000, CYCLING: 25000}
CONTRACTS = ("CDI", "CDD")


@dataclass(frozen=True)
class Rules:
    """Parameters of one run.

    ``policy`` decides what an unknown home address means for the commute bonus:
    ``strict`` leaves the verdict open (no bonus), ``lenient`` accepts the declaration.
    """

    bonus_rate: Decimal = Decimal("0.05")
    wellness_days: int = 5
    wellness_threshold: int = 15
    freshness_days: int = 366
    distance_limits_m: Mapping[str, int] = field(default_factory=lambda: dict(DISTANCE_LIMITS_M))
    contracts: tuple[str, ...] = CONTRACTS
    known_modes: tuple[str, ...] = KNOWN_MODES
    office: tuple[float, float] | None = None
    policy: str = "strict"
    as_of: dt.date | None = None

    def __post_init__(self) -> None:
        if self.policy not in ("strict", "lenient"):
            raise ValueError(f"policy must be 'strict' or 'lenient', not {self.policy!r}")

    @property
    def active_modes(self) -> list[str]:
        return list(self.distance_limits_m)

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None, **overrides) -> Rules:
        """Rules with the deployment's own rates and limits, read from environment variables."""
        env = os.environ if env is None else env
        values = {
            "bonus_rate": Decimal(env.get("TAUX_PRIME", "0.05")),
            "wellness_days": int(env.get("JOURS_BIEN_ETRE", "5")),
            "freshness_days": int(env.get("FRAICHEUR_JOURS", "366")),
            "distance_limits_m": {
                WALKING: int(env.get("DISTANCE_MARCHE", "15000")),
                CYCLING: int(env.get("DISTANCE_VELO", "25000")),
            },
        }
        return cls(**{**values, **overrides})
