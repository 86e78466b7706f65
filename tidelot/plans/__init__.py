"""Feature frames, models and jobs composed from the operators."""
