"""Named query plans (registry), their SQL oracles and plan-inspection helpers."""
