"""The composite jobs. Each chains operators into one lazy plan; ``run`` writes them in order."""
