"""The retention reports: relational (S1-S5b), event pipelines (M0-M4), analysis (P1-P10)."""
