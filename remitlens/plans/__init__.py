"""The jobs: staging, economics, facts, marts, checks, profile, build."""
