"""Configuration-driven plans: query catalog, oracle SQL, alert policies, panels."""
