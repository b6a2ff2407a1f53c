"""Writers for the bronze, silver, control and gold layers."""
