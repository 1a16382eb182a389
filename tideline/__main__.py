from .stages import main

raise SystemExit(main())
