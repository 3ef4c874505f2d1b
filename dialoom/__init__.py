"""Conversation-dataset analytics on Spark: prepare, pack, replay, extract and score chat data."""
