"""Jobs composed of the operators: cleaning, feature preparation, training, scoring, monitoring."""
