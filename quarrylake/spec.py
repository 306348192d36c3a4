"""What the lake holds: sources, their files, and how each column is typed."""

from __future__ import annotations

from dataclasses import dataclass, field

from quarrylake.operators.history import History


@dataclass(frozen=True)
class Source:
    """One raw source: who delivers it, its file format and its folder keys.

    `fields` are the fields of a JSON or XML source, a dot before each nested name and
    `@` before an XML attribute. With them a source is read in one pass as text columns
    named by their path, and what is not declared is kept in `_rescued`. Without them
    Spark infers the columns, which reads every byte twice. `declared` columns are
    there whether or not a file carries them.
    """

    name: str
    system: str
    format: str
    folder: str
    keys: tuple[str, ...] = ()
    root: str | None = None
    envelope: bool = False
    declared: tuple[str, ...] = ()
    fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class Reference:
    """One flat reference file and the kind of history its dimension keeps."""

    name: str
    system: str
    file: str
    key: str
    scd_type: int


# The fields that the JSON sources deliver. The XML source's are not known ahead.
FIELDS = {
    "payments": (
        "payment_id", "external_ref", "amount_minor", "currency", "captured_at", "type", "status", "method", "customer_country",
    ),
    "telemetry": (
        "event_id", "vehicle_id", "ride_id", "ts", "lat", "lon", "speed_kph", "battery", "signal_dbm", "is_locked", "firmware_version",
    ),
    "vehicles": (
        "vehicle_id", "operator_id", "vehicle_type", "manufacturer", "model", "firmware_version", "battery_wh", "top_speed_kph",
        "odometer_km", "purchase_date", "home_city_id", "qr_code", "status",
    ),
    "weather": ("city_id", "period", "source", "date", "tmax_c", "tmin_c", "precip_mm", "wind_kph"),
}

# Delivering systems, formats, folder keys and array roots.
SOURCES = {
    s.name: s
    for s in (
        Source("maintenance", "Trip-Service", "xml", "maintenance", ("period",), root="event"),
        Source("payments", "Payment-Processor", "document", "payments", ("dt",), root="records", fields=FIELDS["payments"]),
        Source("riders_cdc", "Rider-Service", "csv", "riders_cdc", ("dt",)),
        Source("rides", "Trip-Service", "csv", "rides", ("dt",), declared=("promo_code",)),
        Source("telemetry", "IoT-Telemetry", "ndjson", "telemetry", ("city", "dt", "hour"),
               declared=("firmware_version",), fields=FIELDS["telemetry"]),
        Source("vehicles", "Fleet-Registry", "document", "vehicles", ("snapshot_date",), root="vehicles", fields=FIELDS["vehicles"]),
        Source("weather", "Weather-Mirror", "document", "weather", ("city",), root="days", envelope=True, fields=FIELDS["weather"]),
    )
}
REFERENCES = {
    r.name: r
    for r in (
        Reference("cities", "GoogleMaps", "cities.csv", "city_id", 1),
        Reference("operators", "Operators", "operators.csv", "operator_id", 1),
        Reference("plans", "Tariff-Config", "plans.csv", "plan_id", 2),
        Reference("zones", "Geofence-Services", "zones.csv", "zone_id", 2),
    )
}

# The type each text column is read as in the cleaned tables.
TYPES: dict[str, dict[str, str]] = {
    "cities": {"centre_lat": "double", "centre_lon": "double", "population_k": "int"},
    "operators": {"active_from": "date", "revenue_share_pct": "decimal(10,1)"},
    "plans": {
        "version": "int",
        "unlock_fee_eur": "decimal(10,2)",
        "per_minute_eur": "decimal(10,2)",
        "monthly_fee_eur": "decimal(10,2)",
        "valid_from": "date",
        "valid_to": "date",
    },
    "zones": {
        "centroid_lat": "double",
        "centroid_lon": "double",
        "is_current": "boolean",
        "area_km2": "decimal(10,2)",
        "parking_capacity": "int",
        "valid_from": "date",
        "valid_to": "date",
    },
    "riders_cdc": {
        "op_ts": "timestamp",
        "signup_date": "date",
        "marketing_consent": "boolean",
        "birth_year": "int",
    },
    "vehicles": {
        "snapshot_date": "date",
        "battery_wh": "int",
        "top_speed_kph": "double",
        "odometer_km": "double",
        "purchase_date": "date",
    },
    "maintenance": {
        "assigned_at": "timestamp",
        "reported_at": "timestamp",
        "repaired_at": "timestamp",
        "returned_to_service_at": "timestamp",
        "labour_cost": "decimal(10,2)",
    },
    "weather": {
        "date": "date",
        "period": "date",
        "tmax_c": "double",
        "tmin_c": "double",
        "precip_mm": "double",
        "wind_kph": "double",
    },
    "rides": {
        "start_lat": "double",
        "start_lon": "double",
        "end_lat": "double",
        "end_lon": "double",
        "fare_amount": "double",
        "duration_s": "int",
        "is_test": "boolean",
    },
    "payments": {"amount_minor": "bigint", "captured_at": "timestamp"},
    "telemetry": {
        "lat": "double",
        "lon": "double",
        "speed_kph": "double",
        "battery": "decimal(10,4)",
        "is_locked": "boolean",
    },
}

# Columns where text that does not fit is simply missing. In any
# other typed column it is an error, and the row goes to quarantine.
LENIENT: dict[str, tuple[str, ...]] = {
    "plans": ("valid_from", "valid_to"),
    "zones": ("valid_from", "valid_to"),
    "rides": ("start_lat", "start_lon", "end_lat", "end_lon", "fare_amount", "duration_s"),
    "payments": ("captured_at",),
}

# The columns whose change opens a new version.
VEHICLE_HISTORY = History(
    entity="vehicle_id",
    moment="snapshot_date",
    tracked=(
        "firmware_version", "home_city_id", "qr_code", "model", "battery_wh", "operator_id",
        "vehicle_type", "top_speed_kph", "manufacturer", "status", "purchase_date",
    ),
    surrogate="vehicle_sk",
    state_hash="state_hash",
)
RIDER_HISTORY = History(
    entity="rider_id",
    moment="op_ts",
    tracked=("country", "marketing_consent", "plan_id", "operator_id", "home_city_id"),
    surrogate="riders_sk",
    op="op",
)
RIDE_CONTEXT = ("unlock_channel", "end_reason", "is_promo", "is_test")

# The folder each cleaned table is laid out by.
LAYOUT = {
    "weather": ("city",),
    "rides": ("ride_date",),
    "payments": ("payment_date",),
    "telemetry": ("event_date",),
}


@dataclass(frozen=True)
class Lake:
    """Folders of one lake below a root URI."""

    root: str
    sources: dict[str, Source] = field(default_factory=lambda: SOURCES)
    references: dict[str, Reference] = field(default_factory=lambda: REFERENCES)

    def at(self, layer: str, *names: str) -> str:
        return "/".join([self.root.rstrip("/"), layer, *names])

    def landing(self, name: str) -> str:
        if name in self.references:
            return self.at("landing", "reference", self.references[name].file)
        return self.at("landing", self.sources[name].folder)

    def bronze(self, name: str) -> str:
        return self.at("bronze", *(["reference"] if name in self.references else []), name)

    def silver(self, name: str) -> str:
        return self.at("silver", name)

    def gold(self, name: str) -> str:
        return self.at("gold", name)

    def quarantine(self, name: str) -> str:
        return self.at("_quarantine", name)

    def ledger(self, name: str) -> str:
        return self.at("_ledger", name)
