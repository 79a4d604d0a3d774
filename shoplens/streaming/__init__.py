"""Structured Streaming jobs of the ad-click workload."""
