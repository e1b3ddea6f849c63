"""Column work: cleansing, mapping, type landing and the batch calendar. Nothing here shuffles."""
