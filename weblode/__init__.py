"""weblode: turn stored web pages into a typed, de-duplicated metadata index on Spark."""
