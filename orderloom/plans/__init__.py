"""The engine's jobs: staging, marts, features, models, registry, brief, dashboard."""
