"""What several test modules share: fifteen invented people, and plans as text."""

from __future__ import annotations

PEOPLE = [
    (i, name, f"{name.lower()} works on {topic}", department, country)
    for i, (name, topic, department, country) in enumerate(
        [
            ("Alba", "streams", "Engineering", "Chile"),
            ("Bruno", "reports", "Analytics", "Peru"),
            ("Carla", "storage", "Engineering", "Chile"),
            ("Dario", "design", "Product", "Uruguay"),
            ("Elena", "models", "Analytics", "Peru"),
            ("Fabio", "alerts", "Engineering", "Chile"),
            ("Greta", "catalogs", "Engineering", "Peru"),
            ("Hugo", "budgets", "Finance", "Chile"),
            ("Irene", "surveys", "Product", "Uruguay"),
            ("Julia", "parsers", "Engineering", "Peru"),
            ("Karl", "queues", "Engineering", "Chile"),
            ("Lucia", "charts", "Analytics", "Uruguay"),
            ("Mateo", "audits", "Finance", "Peru"),
            ("Nina", "search", "Engineering", "Chile"),
            ("Oscar", "layouts", "Product", "Peru"),
        ],
        start=1,
    )
]
PEOPLE_SCHEMA = "id INT, name STRING, bio STRING, department STRING, country STRING"


def plan_of(df) -> str:
    """The physical plan as text, before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()
